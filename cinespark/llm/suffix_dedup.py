"""Operator 10, suffix-array dedup: bytes covered by a WINDOW-byte string that also starts in an earlier document.

A window's anchor is the least hash of its GRAM-byte strings, a function of the window's bytes alone,
so equal windows have equal anchors. Consecutive windows with one anchor form a segment. The steps:

1. Documents go to groups by the hash of their id (``pid``), once; each later step reads that exchange.
   Exact copies of an earlier text are known from a narrow table of digests: all their windows occur
   earlier, so they only need the result of step 5.
2. Every group lists its anchors, one entry each, however many of its documents have it.
3. Anchors in two documents or more are found per bucket of anchors and told to the groups.
4. The groups send the distinct segments of those anchors, with their least document, to buckets by
   anchor. There the suffixes are sorted in two stages (``two_stage``), adjacent common prefixes of
   WINDOW bytes or more make classes, and the least document of each class goes back to the groups.
5. The groups mark the windows whose class has an earlier document, and cut the bytes they cover.

A passage in a third of all documents gives at most one entry for each group and segment form, so no
task holds its documents. All tables between steps are rows of packed arrays for (group, bucket).

Defined results: a null text is empty and loses nothing; a null doc_id comes after all others, and rows
with the same doc_id are not earlier than each other (each repeated row gets the same result); other
columns are carried along. ``remove_repeats`` puts the remaining bytes back as text; a character cut in
half at an edge is dropped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinespark.llm.common import LAST, _Powers, joined, partitions, shards, span_hashes, table, utf8_list
from cinespark.llm.two_stage import common_prefixes, suffix_order

WINDOW = 50
GRAM = 24
GROUP_BYTES = 16 << 20
SHARD = 1 << 20
SORT_BYTES = 1 << 20      # segments sorted together, or all of one anchor
SALTS = 32                # parts of a group of copies in the join that tells them


def _window_anchors(buf: np.ndarray) -> np.ndarray:
    """Least hash of the grams inside each window of the buffer."""
    n = len(buf)
    with np.errstate(over="ignore"):
        up, down = _Powers.of(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        h = (total[GRAM:] - total[:-GRAM]) * down[:n - GRAM + 1]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    width, have = WINDOW - GRAM + 1, 1
    while have * 2 <= width:
        h = np.minimum(h[:-have], h[have:])
        have *= 2
    return np.minimum(h[:len(h) - (width - have)], h[width - have:]) if have < width else h


def _segments(texts: list[bytes]):
    """Yields for each shard: first text, buffer, text offsets, and its segments (text, first window, windows, anchor)."""
    for a, b in shards(texts, SHARD):
        buf, offsets = joined(texts[a:b])
        if len(buf) <= WINDOW:
            continue
        anchor = _window_anchors(buf)
        usable = np.diff(offsets) - 1 - WINDOW + 1                  # windows of each text
        keep = usable > 0
        if not keep.any():
            continue
        flags = np.zeros(len(anchor) + 1, np.int8)
        np.add.at(flags, offsets[:-1][keep], 1)
        np.add.at(flags, offsets[:-1][keep] + usable[keep], -1)
        inside = np.cumsum(flags[:-1]).astype(bool)
        new = inside.copy()
        new[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
        new[offsets[:-1][keep]] = True
        starts = np.flatnonzero(new)
        text = np.searchsorted(offsets, starts, "right") - 1
        ends = np.minimum(np.append(starts[1:], len(anchor)), (offsets[:-1] + usable)[text])
        yield a, buf, offsets, text, starts, ends - starts, anchor[starts]


def _own(left: pa.Table, right: pa.Table):
    """Texts and order keys of a group, which are copies, and the places of texts that are none (one of equal rows)."""
    texts = utf8_list(left.column("_text").combine_chunks())
    order = left.column("_ord").to_numpy().astype(np.int64)
    copies = {x for x in zip(right.column("copy_ord").to_pylist(), right.column("copy_digest").to_pylist()) if x[1]}
    is_copy = np.array([x in copies for x in zip(order.tolist(), left.column("_digest").to_pylist())], bool)
    seen, kept = set(), []
    for i, t in enumerate(texts):
        if not is_copy[i] and len(t) >= WINDOW and (order[i], t) not in seen:
            seen.add((order[i], t))
            kept.append(i)
    return texts, order, is_copy, kept


def _blobs(table_: pa.Table, name: str, dtype) -> np.ndarray:
    parts = [np.frombuffer(x, dtype) for x in table_.column(name).to_pylist() if x]
    return np.concatenate([*parts, np.zeros(0, dtype)])


def _split_by(bucket: np.ndarray, buckets: int):
    """Stable order by bucket, and the (bucket, first, end) of those that occur."""
    by = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[by], np.arange(buckets + 1))
    return by, [(k, edges[k], edges[k + 1]) for k in np.flatnonzero(np.diff(edges))]


def _list_anchors(buckets: int):
    def anchors(key, left, right):
        texts, _, _, kept = _own(left, right)
        found = []                                                   # anchors, once for each text
        for _, _, _, text, _, _, anchor in _segments([texts[i] for i in kept]):
            by = np.lexsort((anchor, text))
            a, t = anchor[by], text[by]
            found.append(a[np.concatenate([[True], (a[1:] != a[:-1]) | (t[1:] != t[:-1])])] if len(a) else a)
        a = np.concatenate([*found, np.zeros(0, np.uint64)])
        a, count = np.unique(a, return_counts=True)
        by, parts = _split_by((a % np.uint64(buckets)).astype(np.int64), buckets)
        a, many = a[by], (count[by] > 1)
        return pa.table({"bucket": pa.array([k for k, _, _ in parts], pa.int64()),
                         "pid": pa.array([key[0].as_py()] * len(parts), pa.int64()),
                         "anchors": pa.array([a[x:y].tobytes() for _, x, y in parts], pa.binary()),
                         "many": pa.array([np.packbits(many[x:y]).tobytes() for _, x, y in parts], pa.binary())})
    return anchors, "bucket long, pid long, anchors binary, many binary"


def _shared_anchors(key, rows):
    """Anchors that two documents have, for each group that has them."""
    pids = rows.column("pid").to_pylist()
    lists = [np.frombuffer(x, np.uint64) for x in rows.column("anchors").to_pylist()]
    many = [np.unpackbits(np.frombuffer(m, np.uint8), count=len(a)).astype(bool)
            for m, a in zip(rows.column("many").to_pylist(), lists)]
    everything = np.sort(np.concatenate(lists))
    twice = np.union1d(everything[1:][everything[1:] == everything[:-1]], np.concatenate([a[m] for a, m in zip(lists, many)]))
    out = [(p, a[np.isin(a, twice, assume_unique=True)]) for p, a in zip(pids, lists)]
    out = [(p, a.tobytes()) for p, a in out if len(a)]
    return pa.table({"pid": pa.array([p for p, _ in out], pa.int64()), "blob": pa.array([b for _, b in out], pa.binary())})


def _send_segments(buckets: int):
    schema = "bucket long, pid long, anchor binary, size binary, least binary, body binary"

    def segments(key, left, right):
        texts, order, _, kept = _own(left, right)
        shared = np.sort(_blobs(right, "blob", np.uint64))
        least: dict[tuple[int, bytes], int] = {}
        for first, buf, offsets, text, starts, windows, anchor in _segments([texts[i] for i in kept]) if len(shared) else ():
            slot = np.minimum(np.searchsorted(shared, anchor), len(shared) - 1)
            for k in np.flatnonzero(shared[slot] == anchor).tolist():
                s = (int(anchor[k]), buf[starts[k]:starts[k] + windows[k] + WINDOW - 1].tobytes())
                o = int(order[kept[first + text[k]]])
                if least.get(s, o + 1) > o:
                    least[s] = o
        keys = sorted(least)
        anchor = np.array([k[0] for k in keys], np.uint64)
        size = np.array([len(k[1]) for k in keys], np.uint32)
        low = np.array([least[k] for k in keys], np.int64)
        by, parts = _split_by((anchor % np.uint64(buckets)).astype(np.int64), buckets)
        return pa.table({
            "bucket": pa.array([k for k, _, _ in parts], pa.int64()),
            "pid": pa.array([key[0].as_py()] * len(parts), pa.int64()),
            "anchor": pa.array([anchor[by[x:y]].tobytes() for _, x, y in parts], pa.binary()),
            "size": pa.array([size[by[x:y]].tobytes() for _, x, y in parts], pa.binary()),
            "least": pa.array([low[by[x:y]].tobytes() for _, x, y in parts], pa.binary()),
            "body": pa.array([b"".join(keys[j][1] for j in by[x:y]) for _, x, y in parts], pa.binary())})
    return segments, schema


def classes(bodies: list[bytes], least: np.ndarray, window: int = WINDOW):
    """For the windows of each segment, in order: the segment, the place in it and the least document of the class."""
    buf = np.frombuffer(b"".join(bodies), np.uint8)
    size = np.fromiter(map(len, bodies), np.int64, len(bodies))
    base = np.cumsum(size) - size
    windows = size - window + 1
    seg = np.repeat(np.arange(len(bodies)), windows)
    place = np.arange(len(seg)) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = base[seg] + place
    linked = place < windows[seg] - 1
    order, keys = suffix_order(buf, starts, linked, window)
    head = np.flatnonzero(common_prefixes(keys, order) < window)
    low = np.minimum.reduceat(least[seg[order]], head) if len(head) else np.zeros(0, np.int64)
    result = np.empty(len(seg), np.int64)
    result[order] = np.repeat(low, np.diff(np.append(head, len(order))))
    return seg, place, result


def _sort_segments(key, rows):
    """Least document of every window's class, for each group, as changes along each segment."""
    pids, bodies, least, owner, anchors = rows.column("pid").to_pylist(), [], [], [], []
    seen: dict[bytes, int] = {}
    for r, (size, body, low, anchor) in enumerate(zip(*(rows.column(c).to_pylist() for c in ("size", "body", "least", "anchor")))):
        ends = np.cumsum(np.frombuffer(size, np.uint32).astype(np.int64))
        for a, b, o, h in zip([0, *ends[:-1].tolist()], ends.tolist(), np.frombuffer(low, np.int64).tolist(),
                              np.frombuffer(anchor, np.uint64).tolist()):
            s = body[a:b]
            j = seen.setdefault(s, len(bodies))
            if j == len(bodies):
                bodies.append(s)
                least.append(o)
                anchors.append(h)
            least[j] = min(least[j], o)
            owner.append((r, j))
    # equal windows have one anchor, so parts between anchors are sorted one after the other
    order = np.argsort(np.array(anchors, np.uint64), kind="stable")
    moved = np.empty(len(order), np.int64)
    moved[order] = np.arange(len(order))
    bodies, least = [bodies[i] for i in order], np.array(least, np.int64)[order]
    anchors = np.array(anchors, np.uint64)[order]
    found, x, size = [], 0, 0
    for i in range(len(bodies)):
        size += len(bodies[i])
        if i + 1 == len(bodies) or size >= SORT_BYTES and anchors[i + 1] != anchors[i]:
            seg, place, low = classes(bodies[x:i + 1], least[x:i + 1])
            new = np.ones(len(seg), bool)
            new[1:] = (seg[1:] != seg[:-1]) | (low[1:] != low[:-1])
            found.append((seg[new] + x, place[new], low[new]))
            x, size = i + 1, 0
    seg, place, low = (np.concatenate([f[k] for f in found] + [np.zeros(0, np.int64)]) for k in range(3))
    first = np.searchsorted(seg, np.arange(len(bodies) + 1))
    buf, offsets = joined(bodies)
    hashes = span_hashes(buf, offsets[:-1], offsets[1:] - 1)
    r, j = (np.array(x, np.int64) for x in zip(*owner)) if owner else (np.zeros(0, np.int64),) * 2
    j = moved[j]
    out = {"pid": [], "hash": [], "place": [], "low": []}
    for row, pid in enumerate(pids):
        js = j[r == row] if len(pids) < 64 else j[np.searchsorted(r, row):np.searchsorted(r, row + 1)]
        count = first[js + 1] - first[js]
        at = np.repeat(first[js] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        out["pid"].append(pid)
        out["hash"].append(hashes[np.repeat(js, count)].tobytes())
        out["place"].append(place[at].astype(np.uint32).tobytes())
        out["low"].append(low[at].tobytes())
    return pa.table({k: pa.array(v, pa.int64() if k == "pid" else pa.binary()) for k, v in out.items()})


def _cut(out_schema: pa.Schema, with_text: bool, carried: list[str]):
    def cut(key, left, right):
        texts, order, is_copy, _ = _own(left, right)
        h, place, low = _blobs(right, "hash", np.uint64), _blobs(right, "place", np.uint32), _blobs(right, "low", np.int64)
        by = np.lexsort((place, h))
        h, place, low = h[by], place[by].astype(np.int64), low[by]
        n = len(texts)
        removed, spans = np.zeros(n, np.int64), np.zeros(n, np.int64)
        kept = list(texts)
        for i in np.flatnonzero(is_copy).tolist():
            if len(texts[i]) >= WINDOW:
                removed[i], spans[i], kept[i] = len(texts[i]), 1, b""
        others = [i for i in range(n) if not is_copy[i]]
        for shard, buf, offsets, text, starts, windows, _ in _segments([texts[i] for i in others]) if len(h) else ():
            owner = np.array([order[others[shard + t]] for t in range(len(offsets) - 1)], np.int64)
            sk = span_hashes(buf, starts, starts + windows + WINDOW - 1)
            a, b = np.searchsorted(h, sk, "left"), np.searchsorted(h, sk, "right")
            count = b - a
            k = np.repeat(np.arange(len(sk)), count)
            at = np.repeat(a - (np.cumsum(count) - count), count) + np.arange(len(k))
            last = np.append(at[1:] != at[:-1] + 1, True) if len(at) else np.zeros(0, bool)
            last |= np.append(k[1:] != k[:-1], True) if len(k) else last
            until = np.where(last, windows[k], place[np.minimum(at + 1, len(place) - 1)])
            earlier = low[at] < owner[text[k]]
            marks = np.zeros(len(buf) + 1, np.int64)
            np.add.at(marks, (starts[k] + place[at])[earlier], 1)
            np.add.at(marks, (starts[k] + until + WINDOW - 1)[earlier], -1)
            mask = np.cumsum(marks[:-1]) > 0
            if not mask.any():
                continue
            rise = mask.copy()
            rise[1:] &= ~mask[:-1]
            for t in np.unique(np.searchsorted(offsets, np.flatnonzero(rise), "right") - 1).tolist():
                x, y, i = offsets[t], offsets[t + 1] - 1, others[shard + t]
                removed[i], spans[i] = int(mask[x:y].sum()), int(rise[x:y].sum())
                kept[i] = buf[x:y][~mask[x:y]].tobytes()
        cols = {c: left.column(c) for c in carried}
        if with_text:
            cols["text"] = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())
        cols |= {"n_bytes": pa.array([len(t) for t in texts], pa.int64()), "n_removed": pa.array(removed), "n_spans": pa.array(spans),
                 "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())}
        return pa.table({f: cols[f] for f in out_schema})
    return cut


def remove_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """The documents with the repeated bytes cut out of ``text`` (left out unless with_text), and n_bytes, n_removed,
    n_spans (maximal removed runs) and kept_sha256."""
    spark = docs.sparkSession
    taken = {"n_bytes", "n_removed", "n_spans", "kept_sha256"} & set(docs.columns)
    if taken:
        raise ValueError(f"column names {sorted(taken)} are taken by this operator")
    text = F.coalesce("text", F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    groups = max(4 * partitions(spark), total // GROUP_BYTES + 1)
    buckets = max(partitions(spark), total // (2 * GROUP_BYTES) + 1)
    carried = [c for c in docs.columns if c != "text"]
    base = docs.select(*(F.col(f"`{c}`") for c in carried), F.coalesce("doc_id", F.lit(LAST)).alias("_ord"),
                       text.alias("_text"), F.md5(text).alias("_digest"))
    # the least document of each text; narrow rows only
    firsts = base.groupBy("_digest").agg(F.min("_ord").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").select(
        "_digest", "_first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salted = base.select("_ord", "_digest", F.pmod(F.xxhash64("_ord"), F.lit(SALTS)).cast("int").alias("_salt"))
    copies = (salted.join(firsts, ["_digest", "_salt"]).filter("_ord > _first")
              .select(F.col("_ord").alias("copy_ord"), F.col("_digest").alias("copy_digest")).distinct())
    dealt = base.withColumn("_pid", F.pmod(F.xxhash64("_ord"), F.lit(groups))).groupBy("_pid")
    marked = copies.select(F.pmod(F.xxhash64("copy_ord"), F.lit(groups)).alias("pid"), "copy_ord", "copy_digest")

    def told(df: DataFrame):
        return df.unionByName(marked, allowMissingColumns=True).groupBy("pid")

    fn, schema = _list_anchors(buckets)
    listed = dealt.cogroup(marked.groupBy("pid")).applyInArrow(fn, schema)
    shared = listed.groupBy("bucket").applyInArrow(_shared_anchors, "pid long, blob binary")
    fn, schema = _send_segments(buckets)
    sent = dealt.cogroup(told(shared)).applyInArrow(fn, schema)
    found = sent.groupBy("bucket").applyInArrow(_sort_segments, "pid long, hash binary, place binary, low binary")
    kinds = {f.name: f for f in docs.schema.fields}
    fields = [kinds[c] for c in docs.columns if c != "text" or with_text]
    fields += [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")] + [T.StructField("kept_sha256", T.StringType())]
    return dealt.cogroup(told(found)).applyInArrow(
        _cut([f.name for f in fields], with_text, carried), T.StructType(fields))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, with_text=False)
