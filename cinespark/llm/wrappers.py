"""Operator 1, main text of pages by wrappers inferred for each host.

A page becomes a stream of block tags and text slots. The wrapper of a host is a union-free expression over
such streams, found by aligning one stream after the other, element by element: neighbours of one tag become a
repeated group, elements that one side lacks become optional groups, texts that differ become slots, and equal
texts stay constants, as long as all but a few of the host's distinct pages carry them. Alignment of two wrappers gives a wrapper, so tasks reduce their pages per host first
and one row for each (host, task) is aligned at the end, however many pages a host has.

A wrapper then says where the main text is: the groups named as article or main, or else the deepest group
that holds most of the slots' text, without groups named as page furniture (menus, headers, footers, sidebars,
notices, adverts, forms, comments) and without constants. Article and main tags and roles win over furniture names, and so
does a group with most of the slots' text where no main group stands outside of it. Extraction walks a page by these paths.

Defined results: null or empty html, and pages without text, give the empty text; a null url or one without a
host belongs to the host ''; repeated pages are one page for the constants; other columns are carried along.
"""

from __future__ import annotations

import hashlib
import html as references
import json
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinespark.llm.common import table

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "svg", "template", "math", "select", "object", "canvas", "audio", "video"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span "
             "strike strong sub sup time tt u var img br wbr input".split())
#: Open elements that a new block ends.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"},
          "th": {"td", "th", "p"}, "option": {"option"}}
SCOPE = {"ul", "ol", "table", "article", "section", "div", "body", "html", "main", "blockquote", "dl", "td", "th", "nav", "aside", "footer", "header"}
FURNITURE_TAGS = set("head nav header footer aside form button menu dialog fieldset input address".split())
FURNITURE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adslot banner promo promotion sponsor sponsored nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar side aside rail footer foot header masthead topbar notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe "
    "subscription signup login social share sharing related recommended recommendation recommendations comment comments commentlist reply replies respond "
    "disqus discussion search pagination pager toolbar widget copyright legal skip hidden paywall".split())
#: Words that stand beside a furniture word in the name of furniture (site-header, main-nav, sidebar-left).
NEUTRAL_WORDS = set(
    "site page main global top bottom left right primary secondary wrapper wrap container box bar block area section region inner outer list item items link "
    "links widget widgets button buttons icon icons panel group row col column post posts article articles entry content body form field text title js fixed "
    "sticky mobile desktop small large first last".split())
#: First words of names that tell what a page has, belongs to or looks like, not what the element is.
MODIFIERS = set("has with without no not is category cat tag tags type format status author topic show hide".split())
FURNITURE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}
MAIN_TAGS = {"article", "main"}
MAIN_WORDS = {"article", "main", "content", "post", "entry", "story", "maincontent", "articlebody", "entrycontent", "postcontent", "postbody"}
CONSTANT_PAGES = 5        # distinct pages of a host from which an equal text counts as a constant
CONSTANT_SHARE = 0.9      # of a host's distinct pages that carry a constant
MAIN_SHARE = 0.6          # of the slots' text that an unnamed main group holds
_VARIES = 0


def _words(value: str) -> list[str]:
    return [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", value or "")]


def furniture_name(name: str) -> bool:
    """Whether a whole class or id names page furniture: a furniture word, with nothing but neutral words beside it."""
    if re.sub(r"[^a-z]", "", name.lower()) in FURNITURE_WORDS:
        return True
    words = _words(name)
    return bool(words) and words[0] not in MODIFIERS and bool(FURNITURE_WORDS & set(words)) and not set(words) - FURNITURE_WORDS - NEUTRAL_WORDS


def main_name(name: str) -> bool:
    words = _words(name)
    return bool(words) and words[0] not in MODIFIERS and (bool(MAIN_WORDS & set(words)) or re.sub(r"[^a-z]", "", name.lower()) in MAIN_WORDS)


class _Names(dict):
    """Signature of a start tag: name and class words, ``!`` in front if tag, role or style make it page furniture, ``~`` if
    only its class or id does, ``*`` if it is the main group."""

    def __missing__(self, key):
        name, raw = key
        attrs = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw)}
        words = _words(attrs.get("class", "")) + _words(attrs.get("id", ""))
        names = (attrs.get("class", "") + " " + attrs.get("id", "")).split()
        role = attrs.get("role", "").lower()
        kind = ""
        if name in ("html", "body"):
            pass
        elif (name in FURNITURE_TAGS and role not in ("main", "article") or role in FURNITURE_ROLES or "hidden" in attrs
              or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attrs.get("style", ""))):
            kind = "!"
        elif name in MAIN_TAGS or role in ("main", "article"):
            kind = "*"
        elif any(map(furniture_name, names)):
            kind = "~"
        elif any(map(main_name, names)):
            kind = "*" if name not in INLINE else ""
        value = kind + ".".join([name, *sorted(set(words))[:6]])
        if len(self) > 100_000:
            self.clear()
        self[key] = value
        return value


_NAMES = _Names()


def blocks(page: str):
    """(path of block signatures, text) of the page's texts in order; inline tags do not part a block."""
    stack: list[tuple[str, str]] = []                                # (tag, signature)
    pieces: list[str] = []
    out: list[tuple[tuple[str, ...], str]] = []

    def flush():
        if pieces:
            text = " ".join(references.unescape("".join(pieces)).split())
            if text:
                out.append((tuple(s for _, s in stack), text))
            pieces.clear()

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if not m:
            pieces.append(page[at:])
            break
        if m.start() > at:
            pieces.append(page[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if name in INLINE and not any(t == name for t, _ in stack):
                continue
            if any(t == name for t, _ in stack):
                flush()
                while stack and stack.pop()[0] != name:
                    pass
            elif name not in INLINE:
                flush()
            continue
        if name in RAW:
            if not m[3].endswith("/"):
                close = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = close.end() if close else end
            if name not in INLINE:
                flush()
            continue
        if name in VOID:
            if name in ("br", "img", "wbr", "input"):
                pieces.append("" if name == "wbr" else " ")
            else:
                flush()
            continue
        signature = _NAMES[name, m[3]]
        if name in INLINE:
            if signature[0] in "!~" and not m[3].endswith("/"):       # furniture inside a block: without its text
                close = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = close.end() if close else at
                pieces.append(" ")
            continue
        flush()
        ended = CLOSES.get(name, {"p"})
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in ended:
                del stack[k:]
            elif stack[k][0] in SCOPE and name != "tr":
                break
        if not m[3].endswith("/"):
            stack.append((name, signature))
    flush()
    return out


# -- wrappers: [signature, children, repeated, optional, constant, text mass, pages], a text slot has the signature #


def _slot(text: str):
    return ["#", [], False, False, zlib.crc32(text.encode("utf-8", "surrogatepass")) | 1 << 32, len(text), 1]


def page_wrapper(page: list[tuple[tuple[str, ...], str]]):
    """The stream of one page as a wrapper; neighbouring elements of one signature are aligned into a repeated group."""
    root = ["", [], False, False, None, 0, 1]
    for path, text in page:
        node = root
        for signature in path:
            if not node[1] or node[1][-1][0] != signature:
                node[1].append([signature, [], False, False, None, 0, 1])
            node = node[1][-1]
        node[1].append(_slot(text))
    return _fold(root)


def _fold(node):
    children: list = []
    for child in map(_fold, node[1]):
        if children and children[-1][0] == child[0]:
            children[-1] = align(children[-1], child)
            children[-1][2] = True
        else:
            children.append(child)
    node[1] = children
    return node


def align(a, b):
    """The wrapper that covers both. Pages add up; inside a repeated group, where they do not, nothing is constant."""
    out = [a[0], [], a[2] or b[2], a[3] or b[3], a[4] if a[4] == b[4] else _VARIES, a[5] + b[5], a[6] + b[6]]
    x, y = a[1], b[1]
    if [n[0] for n in x] == [n[0] for n in y]:
        out[1] = [align(p, q) for p, q in zip(x, y)]
        return out
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i][0] == y[j][0] else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    merged = []
    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and x[i][0] == y[j][0]:
            merged.append(align(x[i], y[j]))
            i, j = i + 1, j + 1
        elif j == len(y) or i < len(x) and best[i + 1][j] >= best[i][j + 1]:
            merged.append([*x[i][:3], True, *x[i][4:]])
            i += 1
        else:
            merged.append([*y[j][:3], True, *y[j][4:]])
            j += 1
    for n in merged:                                                 # groups that meet now are one repeated group
        if out[1] and out[1][-1][0] == n[0]:
            optional = out[1][-1][3] and n[3]
            out[1][-1] = align(out[1][-1], n)
            out[1][-1][2], out[1][-1][3] = True, optional
        else:
            out[1].append(n)
    return out


def pattern(node) -> str:
    """The wrapper as an expression: #TEXT slots, constants by checksum, ( ... )+ and ( ... )?."""
    if node[0] == "#":
        s = "#TEXT" if node[4] == _VARIES or node[2] else f"#{node[4] & 0xFFFFFFFF:08x}"
    else:
        inner = " ".join(map(pattern, node[1]))
        s = f"<{node[0].lstrip('!~*')}> {inner} </>" if node[0] else inner
    if node[2] or node[3]:
        s = f"( {s} )" + ("+" if node[2] else "") + ("?" if node[3] else "")
    return s


def _dropped(path: tuple[str, ...], kept: set) -> bool:
    """Whether a path leads through furniture; ``kept`` are the paths that only bear the name of furniture."""
    return any(s[0] == "!" or s[0] == "~" and path[:k + 1] not in kept for k, s in enumerate(path))


def _mass(node, path: tuple[str, ...], kept: set | None) -> int:
    """Text of the slots outside furniture; names alone make no furniture without ``kept``."""
    if node[0].startswith("!") or kept is not None and node[0].startswith("~") and path not in kept:
        return 0
    return node[5] + sum(_mass(c, path + (c[0],), kept) for c in node[1])


def _misnamed(root) -> set[tuple[str, ...]]:
    """Paths of groups with the name of furniture that hold most of the slots' text, with no main group outside of them."""
    total = _mass(root, (), None)
    out: set[tuple[str, ...]] = set()

    def main_outside(node) -> bool:
        return any(c[0][:1] == "*" or main_outside(c) for c in node[1] if c[0][:1] not in ("!", "~"))

    def walk(node, path):
        for c in node[1]:
            if c[0] == "#" or c[0].startswith("!"):
                continue
            if c[0].startswith("~"):
                if _mass(c, path + (c[0],), None) < MAIN_SHARE * max(total, 1):
                    continue
                out.add(path + (c[0],))
            walk(c, path + (c[0],))

    if not main_outside(root):
        walk(root, ())
    return out


def rules(root, pages: int) -> dict:
    """Paths of the main groups (prefixes of block paths), constants (path and checksum) and misnamed groups of a wrapper."""
    kept = _misnamed(root)
    total = _mass(root, (), kept)
    named: list[tuple[tuple[str, ...], int]] = []

    def find(node, path):
        for child in node[1]:
            below = path + (child[0],)
            if child[0] == "#" or _dropped(below, kept):
                continue
            if child[0].startswith("*"):
                named.append((below, _mass(child, below, kept)))
            find(child, below)

    find(root, ())
    main: list[tuple[str, ...]] = []
    for kind in ("*article", "*main", "*"):
        chosen = [p for p, _ in named if p[-1].startswith(kind) and (kind == "*" or p[-1].split(".")[0] == kind)]
        if sum(m for p, m in named if p in chosen and not any(p[:k] in chosen for k in range(1, len(p)))) >= 0.3 * max(total, 1) and chosen:
            main = [p for p in chosen if not any(p[:k] in chosen for k in range(1, len(p)))]
            break
    if not main:
        node, path = root, ()
        while True:
            inner = [c for c in node[1] if c[0] != "#" and c[1]]
            weigh = lambda c: _mass(c, path + (c[0],), kept)
            heavy = max(inner, key=weigh, default=None)
            if heavy is None or weigh(heavy) < MAIN_SHARE * max(total, 1) or all(c[0] == "#" for c in heavy[1]):
                break
            node, path = heavy, path + (heavy[0],)
        main = [path]
    constants: list[tuple[tuple[str, ...], int]] = []
    slots = [0]

    def fixed(node, path, free):
        for child in node[1]:
            if child[0] == "#":
                if child[4] == _VARIES or child[2] or not free or child[6] < CONSTANT_SHARE * pages:
                    slots[0] += 1
                else:
                    constants.append((path, child[4]))
            elif not _dropped(path + (child[0],), kept):
                fixed(child, path + (child[0],), free and not child[2])

    fixed(root, (), True)
    if pages < CONSTANT_PAGES or not slots[0]:
        constants = []
    return {"main": [list(p) for p in sorted(set(main))], "constants": [[list(p), c] for p, c in constants],
            "kept": [list(p) for p in sorted(kept)]}


def main_text(page: str | None, rule: dict | None) -> str:
    """The main text by the rules of the host's wrapper; by the page's own if they find none."""
    found = blocks(page or "")
    if not found:
        return ""
    for given in (rule, None):
        if given is None:
            given = rules(page_wrapper(found), 1)
        main = [tuple(p) for p in given["main"]]
        constants = {(tuple(p), c) for p, c in given["constants"]}
        kept = {tuple(p) for p in given["kept"]}
        text = "\n".join(t for path, t in found if any(path[:len(p)] == p for p in main) and not _dropped(path, kept)
                         and (not constants or (path, zlib.crc32(t.encode("utf-8", "surrogatepass")) | 1 << 32) not in constants))
        if text:
            return text
    return ""


def _streams(batches):
    """Pages without their texts; the digest tells pages whose blocks differ."""
    for batch in batches:
        found = [blocks(page) for page in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([hashlib.md5(json.dumps(f).encode()).digest() for f in found], pa.binary()),
             pa.array([json.dumps(page_wrapper(f), separators=(",", ":")) for f in found], pa.string())], names=["host", "digest", "wrapper"])


def _infer(batches):
    found: dict[str, list] = {}
    for batch in batches:
        for host, wrapper in zip(batch.column(0).to_pylist(), map(json.loads, batch.column(1).to_pylist())):
            found[host] = [align(found[host][0], wrapper), found[host][1] + 1] if host in found else [wrapper, 1]
    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([json.dumps(w) for w, _ in found.values()], pa.string()),
                                      pa.array([n for _, n in found.values()], pa.int64())], names=["host", "wrapper", "pages"])


def _reduce(key, rows):
    wrapper, pages = None, 0
    for w, n in sorted(zip(rows.column("wrapper").to_pylist(), rows.column("pages").to_pylist())):
        w = json.loads(w)
        wrapper, pages = (align(wrapper, w) if wrapper else w), pages + n
    return pa.table({"host": pa.array([key[0].as_py()], pa.string()), "pages": pa.array([pages], pa.int64()),
                     "pattern": pa.array([pattern(wrapper)], pa.string()), "rules": pa.array([json.dumps(rules(wrapper, pages))], pa.string())})


def host_of(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """host, pages, pattern (the union-free expression) and rules (JSON) of every host."""
    streams = pages.filter(F.length("html") > 0).select(host_of(F.col("url")).alias("host"), "html")
    distinct = (streams.mapInArrow(_streams, "host string, digest binary, wrapper string").dropDuplicates(["host", "digest"])
                .select("host", "wrapper"))
    return distinct.mapInArrow(_infer, "host string, wrapper string, pages long").groupBy("host").applyInArrow(
        _reduce, "host string, pages long, pattern string, rules string")


_RULES: dict[str, dict] = {}


def _rule(text: str | None) -> dict | None:
    if text is None:
        return None
    if text not in _RULES:
        if len(_RULES) > 10_000:
            _RULES.clear()
        _RULES[text] = json.loads(text)
    return _RULES[text]


def extract(pages: DataFrame, out: str = "text") -> DataFrame:
    """Adds ``out``: the main text of each page."""
    if out in pages.columns or "_host" in pages.columns or "_rules" in pages.columns:
        raise ValueError(f"the column names {out!r}, '_host' and '_rules' are taken by this operator")

    def run(page: pa.Array, rule: pa.Array) -> pa.Array:
        return pa.array([main_text(p, _rule(r)) for p, r in zip(page.to_pylist(), rule.to_pylist())], pa.string())

    known = infer_wrappers(pages).select(F.col("host").alias("_host"), F.col("rules").alias("_rules"))
    return (pages.withColumn("_host", host_of(F.col("url"))).join(known, "_host", "left")
            .withColumn(out, F.arrow_udf(run, "string")(F.col("html"), F.col("_rules"))).select(*pages.columns, out))


def op1_host_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
