"""Operator 6, quality rules (native): line-first cleaning.

Every line with a word is judged by three kinds of rules. Punctuation: too many symbols, too many doubled
exclamation marks, a short line that trails off in an ellipsis, or a long one without any closing mark.
Navigation: short items between separators, or words of menus one after another, without a closing mark.
Boilerplate: set phrases that make up most of a short line, or few different words over and over. Failing lines
go, and a document is rejected when too little of its text is left. All work is in Spark SQL expressions on one
row, so nothing is shuffled and a hot source has no effect. Arrays are bound once by a one-element
``transform``, so no expression is evaluated again for each element.

Defined results: null and empty texts have no words and fail the base rule; repeated rows are judged one by one;
columns beside the text are carried along untouched by ``clean``, whatever their names; an empty table gives no
rows. Words that repeat are told by 64-bit hashes of three words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinespark.llm.common import free_name, table

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Phrases of page furniture, in lower case; they condemn short lines of which they are the most part.
BOILERPLATE = "|".join([
    "all rights reserved", r"copyright( ©| \(c\))?( [0-9]{4})?", "privacy policy", "terms (of|and) (use|service|conditions)",
    "cookie (policy|settings|preferences)", "(accept|allow|reject) (all )?cookies", "^(we|this site|this website) uses? cookies.*",
    "^(please )?enable javascript.*", "^lorem ipsum.*", "^subscribe (to|now).*", "^(please )?(sign|log) (in|up|out) (to|or) .*",
    "(sign|log) (in|up|out)", "log(in|out)", "register now", "^click here (to|for) .*", "click here", "read more",
    "^share (this|on) .*", "back to (the )?top"])
#: Words of menus, in lower case.
MENU_WORDS = ("home about contact contacts products product services service news blog faq help search login logout register "
              "menu sitemap shop cart account privacy terms support downloads careers press archive archives next previous").split()
#: Between the items of a menu; a slash, a dash or a bullet stands between blanks, or blanks are doubled.
SEPARATORS = r" *[|·•»›→>] *| [/\\–—*-] |\t+|  +"
#: Marks that close a sentence, with quotes or brackets after them.
CLOSING = r"[.!?…。！？][\"'’”»)\]]*([\x20\x09-\x0D]|\z)"
ELLIPSIS = r"(\.\.\.|…)[\x20\x09-\x0D]*\z"
SHORT_LINE = 20          # words of a line that a boilerplate phrase or an ellipsis can condemn
LONG_LINE = 30           # words of a line that must close a sentence somewhere
SYMBOL_SHARE = 0.3       # symbols per word from which a line fails
SHOUT_SHARE = 0.3        # doubled exclamation marks per word from which a line fails
ITEMS, ITEM_WORDS = 3, 3  # a menu has at least so many items of so many words on average
MENU_SHARE = 0.6         # share of menu words from which a line of three words or more is a menu
REPEAT_WORDS = 10        # of so many words or more, the lesser of these two must differ:
DISTINCT_SHARE, DISTINCT_LOG = 0.2, 4.3   # a share of the words, or a multiple of the logarithm of their number (a long line repeats its words)
MIN_KEPT = 0.5           # share of a document's word characters that must be left


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _without(s: Column, chars: str) -> Column:
    for c in chars:
        s = F.replace(s, F.lit(c), F.lit(""))
    return s


def _lower(s: Column) -> Column:
    """A-Z lowered, all else as it is."""
    return F.translate(s, _UPPER, _UPPER.lower())


def _words(s: Column) -> Column:
    return F.filter(F.split(s, SPACES), lambda w: w != "")


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value evaluated once per row."""
    return F.transform(F.array(value), use)[0]


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("g"), i.alias("p")))

    def positions(s: Column) -> Column:
        found = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (
            (F.get(s, i - 1)["g"] == F.get(s, i)["g"]) | (F.get(s, i + 1)["g"] == F.get(s, i)["g"])))
        return F.sort_array(F.transform(found, lambda i: F.get(s, i)["p"]))

    covered = F.aggregate(
        _bind(F.sort_array(windows), positions),
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"])
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(covered)


def _menu(line: Column, n: Column, low: Column) -> Column:
    """Short items between separators, or mostly menu words; ``n`` words, no closing mark."""
    items = _bind(F.filter(F.split(line, SEPARATORS), lambda x: F.trim(x) != ""), lambda x: (F.size(x) >= ITEMS) & (n <= ITEM_WORDS * F.size(x)))
    known = F.size(F.filter(low, lambda w: w.isin(MENU_WORDS)))
    return ~line.rlike(CLOSING) & ((line.rlike(SEPARATORS) & items) | ((n >= 3) & (known >= MENU_SHARE * n)))


def _phrases(line: Column) -> Column:
    """Whether boilerplate phrases hold half of the line's word characters."""
    low = _lower(line)
    return low.rlike(rf"\b({BOILERPLATE})\b") & (2 * _solid(F.regexp_replace(low, rf"\b({BOILERPLATE})\b", "")) <= _solid(line))


def _fails(line: Column, w: Column) -> Column:
    """Whether a line with the words ``w`` (one at least) fails a rule."""
    n = F.size(w)
    return ((F.length(line) - F.length(_without(line, SYMBOLS)) > SYMBOL_SHARE * n)
            | (line.contains("!!") & ((F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("")))) / 2 > SHOUT_SHARE * n))
            | ((n >= REPEAT_WORDS) & (F.size(F.array_distinct(w)) < F.least(DISTINCT_SHARE * n, DISTINCT_LOG * F.log(n))))
            | ((n <= SHORT_LINE) & (line.rlike(ELLIPSIS) | _phrases(line)))
            | ((n >= LONG_LINE) & ~line.rlike(CLOSING))
            | ((n <= ITEM_WORDS * SHORT_LINE) & _menu(line, n, F.transform(w, _lower))))


def line_fails(line: Column) -> Column:
    """Whether a line fails a rule; lines without a word pass."""
    return _bind(_words(line), lambda w: (F.size(w) > 0) & _fails(line, w))


def _solid(s: Column) -> Column:
    """Code points that belong to words."""
    return F.length(_without(s, " \t\n\x0b\x0c\r"))


def judgement(text: str = "text") -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    lines_removed, kept_chars, clean_text and kept."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    stats = _bind(_words(t), lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                                _repeat_words(w).alias("n_repeat_words")))

    def by_lines(lines: Column) -> Column:
        worded = F.filter(lines, lambda x: _solid(x) > 0)
        return F.struct(
            _bind(worded, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.filter(lines, lambda x: ~line_fails(x)).alias("left"),
            F.size(lines).alias("n"))

    def verdict(s: Column, ln: Column) -> Column:
        clean = F.array_join(ln["left"], "\n")
        chars, left = _solid(t), _solid(clean)
        failed = (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])
        return F.struct(
            s["n_words"].alias("n_words"), chars.cast("long").alias("word_chars"),
            (F.length(t) - F.length(_without(t, SYMBOLS))).cast("long").alias("n_symbols"),
            ln["n_dup_lines"].alias("n_dup_lines"), s["n_repeat_words"].alias("n_repeat_words"),
            failed.alias("base_failed"), (ln["n"] - F.size(ln["left"])).alias("lines_removed"),
            left.cast("long").alias("kept_chars"), clean.alias("clean_text"),
            (~failed & (left >= MIN_KEPT * chars)).alias("kept"))

    return _bind(stats, lambda s: _bind(by_lines(F.split(t, "\n")), lambda ln: verdict(s, ln)))


def judge(docs: DataFrame, text: str = "text", out: str = "judged") -> DataFrame:
    """Adds ``out`` (with _ in front where a column has the name), the ``judgement`` of each text."""
    return docs.withColumn(free_name(out, docs.columns), judgement(text))


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents that pass, without their failing lines; the columns stay as they were."""
    out = free_name("judged", docs.columns)
    # one generator judges and filters, so no text is judged twice
    passed = F.explode(F.filter(F.array(judgement(text)), lambda j: j["kept"]))
    rows = docs.select("*", passed.alias(out))
    cols = {text: F.col(f"{out}.clean_text")}
    if "n_chars" in docs.columns:
        cols["n_chars"] = F.length(F.col(f"{out}.clean_text")).cast("long")
    return rows.withColumns(cols).select([F.col(f"`{c}`") for c in docs.columns])


def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs).select("doc_id", *(f"judged.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")))


def oracle_ctes(source: str = "documents", name: str = "judged", extra: str = "") -> str:
    """DuckDB CTEs giving ``judged`` (doc_id, the counts, kept, clean_text, and ``extra`` columns) for a table."""
    def less(s: str, chars: str) -> str:
        for c in chars:
            s = f"replace({s}, chr({ord(c)}), '')"
        return s
    spaces, symbols = " \t\n\x0b\x0c\r", SYMBOLS
    words = "list_filter(string_split_regex({0}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
    line_words, quoted = words.format("x"), lambda r: "'" + r.replace("'", "''") + "'"
    n, low = f"len({line_words})", f"translate(x, '{_UPPER}', '{_UPPER.lower()}')"
    phrases = quoted(rf"\b({BOILERPLATE})\b")
    closed = f"regexp_matches(x, {quoted(CLOSING)})"
    items = f"len(list_filter(string_split_regex(x, {quoted(SEPARATORS)}), lambda y: trim(y) <> ''))"
    known = f"len(list_filter(string_split_regex({low}, '[\\x20\\x09-\\x0D]+'), lambda w: w IN ({', '.join(map(quoted, MENU_WORDS))})))"
    fails = f"""({n} > 0 AND (
        length(x) - length({less('x', symbols)}) > {SYMBOL_SHARE} * {n}
        OR (length(x) - length(replace(x, '!!', ''))) / 2 > {SHOUT_SHARE} * {n}
        OR ({n} >= {REPEAT_WORDS} AND len(list_distinct({line_words})) < least({DISTINCT_SHARE} * {n}, {DISTINCT_LOG} * ln({n})))
        OR ({n} <= {SHORT_LINE} AND (regexp_matches(x, {quoted(ELLIPSIS)}) OR (regexp_matches({low}, {phrases})
            AND 2 * length({less(f"regexp_replace({low}, {phrases}, '', 'g')", spaces)}) <= length({less('x', spaces)}))))
        OR ({n} >= {LONG_LINE} AND NOT {closed})
        OR ({n} <= {ITEM_WORDS * SHORT_LINE} AND NOT {closed} AND (
            (regexp_matches(x, {quoted(SEPARATORS)}) AND {items} >= {ITEMS} AND {n} <= {ITEM_WORDS} * {items})
            OR ({n} >= 3 AND {known} >= {MENU_SHARE} * {n})))))"""
    return f"""{name}_a AS (
      SELECT row_number() OVER () AS rid, doc_id {extra}, coalesce(text, '') AS t FROM {source}),
    {name}_b AS (SELECT *, {words.format('t')} AS w, string_split(t, chr(10)) AS l FROM {name}_a),
    {name}_c AS (SELECT *, len(w) AS n_words, list_filter(l, lambda x: length({less('x', spaces)}) > 0) AS worded,
             array_to_string(list_filter(l, lambda x: NOT {fails}), chr(10)) AS clean_text FROM {name}_b),
    {name}_g AS (SELECT rid, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS g
          FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS p FROM {name}_b WHERE len(w) >= 3)),
    {name}_r AS (SELECT rid, count(DISTINCT q) AS n FROM (
          SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM (
            SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS c FROM {name}_g) WHERE c > 1) GROUP BY rid),
    {name}_s AS (SELECT c.*, coalesce(r.n, 0) AS n_repeat_words,
             length({less('t', spaces)}) AS word_chars, length({less('clean_text', spaces)}) AS left_chars
          FROM {name}_c c LEFT JOIN {name}_r r USING (rid)),
    {name} AS (SELECT doc_id {extra}, clean_text, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
             CAST(length(t) - length({less('t', symbols)}) AS BIGINT) AS n_symbols,
             CAST(len(worded) - len(list_distinct(worded)) AS BIGINT) AS n_dup_lines,
             CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
             (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
             (NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND left_chars >= {MIN_KEPT} * word_chars) AS kept
          FROM {name}_s)"""


ORACLE = f"""WITH {oracle_ctes()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"""
