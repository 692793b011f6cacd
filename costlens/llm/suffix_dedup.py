"""Exact removal of byte strings that an earlier document has too.

A byte is removed if a string of ``WINDOW`` bytes over it also starts in a
document with a smaller id. The work is cut so that no step sees more than a
bounded part of the corpus:

1. Documents are dealt into groups by a hash of their id.
2. The strings that start in a document are assigned to anchors: each string to
   the k-gram in it with the smallest hash (the last of equal ones). Equal
   strings have equal anchors at equal places, whatever stands around them.
   The more a corpus holds, the more k-grams repeat by chance, so what is
   compared is longer: an anchor's strings either have at least ``BEFORE`` bytes
   before it or over ``BEHIND`` bytes behind it. Each of these two halves has a
   key, the hash of the k-gram with those bytes. Halves whose key occurs in one
   document only cannot match and drop out here.
3. For each remaining half, the stretch of text that holds its strings goes
   to the shard of the anchor's hash (one stretch where both halves remain).
   Within a group a stretch that repeats goes out once; its repetitions in later
   documents are settled at once.
4. A shard goes through its anchors in ``PARTS`` parts, and builds for each a
   sparse suffix array of its different stretches: only the suffixes that start
   a string are sorted, by 8 bytes, then by as many further bytes a time as fit
   beside their rank, only unsettled suffixes being sorted again, up to exactly
   ``WINDOW`` bytes. The common prefixes of neighbours in suffix order follow
   with the ranks as strides. Neighbours with ``WINDOW`` common bytes are one
   string; the smallest id among its documents keeps it, the others' bytes go.
5. An anchor with very many stretches is split over several shards. What each
   of them keeps goes, as sorted runs, to a second set of shards by the string
   itself, where the runs are merged by binary search. A string reaches that
   step once per shard, so no group of it is large.
6. Each group joins its documents with the spans found and cuts them out.

The text crosses the network once: all steps on documents use the same
exchange.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import group_count, release

WINDOW = 50
GRAM = 20
#: Bytes before an anchor in its left half's key, and behind it in its right half's: a string has one or the other.
BEFORE = (WINDOW - GRAM) // 2
BEHIND = WINDOW - GRAM - BEFORE + 1
#: Parts of a shard's anchors: one suffix array each.
PARTS = 8
#: Shards whose keys are counted together.
COUNTED = 2
#: Stretches of one anchor that a shard may get; the anchors with more are split.
MOST_STRETCHES = 4096

_MIX = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_LOW = np.uint64(0xFFFFFFFF)

#: One row per group and target: packed arrays of stretches. A negative route
#: means spans of group ``-1 - route`` instead: rows, starts and ends.
PACKED = "route long, docs binary, groups binary, rows binary, starts binary, sizes binary, split binary, parts binary, text binary"


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` values in a row."""
    n, step = len(values) - width + 1, 1
    while 2 * step <= width:
        values = pick(values[:-step], values[step:])
        step *= 2
    return pick(values[:n], values[width - step : width - step + n])


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each position on."""
    h, step, factor = (b.astype(np.uint64) + np.uint64(1)) * np.uint64(_MIX[0]), 1, _MIX[1]
    n = len(b) - GRAM + 1
    while 2 * step <= GRAM:
        h = h[:-step] * np.uint64(factor) + h[step:]
        factor = factor * factor % 2**64
        step *= 2
    h = h[:n] * np.uint64(_MIX[3]) + h[GRAM - step : GRAM - step + n]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(_MIX[2])
    return h ^ (h >> np.uint64(32))


def _mixed(h: np.ndarray, other: np.ndarray, factor: int) -> np.ndarray:
    h = h * np.uint64(factor) + other
    h = (h ^ (h >> np.uint64(29))) * np.uint64(_MIX[2])
    return h ^ (h >> np.uint64(32))


def _runs(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, place) of the runs of string starts with one anchor, and the hashes of all grams."""
    if len(b) < WINDOW:
        return (*(np.empty(0, np.int64) for _ in range(3)), np.zeros(1, np.uint64))
    h = gram_hashes(b)
    place = np.arange(len(h), dtype=np.uint64)
    low = _sliding((h & ~_LOW) | (_LOW - place), WINDOW - GRAM + 1, np.minimum)
    at = (_LOW - (low & _LOW)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    last = np.r_[first[1:], len(at)] - 1
    return first, last, at[first], h


def _anchor_hash(h: np.ndarray) -> np.ndarray:
    value = h * np.uint64(_MIX[1])
    return value ^ (value >> np.uint64(31))


def anchors(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, hash): runs of string starts with one anchor, and the anchor's hash."""
    first, last, at, h = _runs(b)
    return first, last, _anchor_hash(h[at])


def halves(b: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first, turn, last, hash, left, right) of the runs with one anchor.

    The strings from ``first`` on have the bytes of the key ``left``, those from ``turn``
    to ``last`` the bytes of ``right``. A half without strings has a key without meaning.
    """
    first, last, at, h = _runs(b)
    turn = np.minimum(np.maximum(first, at - BEFORE + 1), last + 1)
    left = _mixed(h[np.maximum(at - BEFORE, 0)], h[at], _MIX[1])
    right = _mixed(h[at], h[np.minimum(at + BEHIND, len(h) - 1)], _MIX[3])
    return first, turn, last, _anchor_hash(h[at]), left, right


def suffix_ranks(text: np.ndarray, starts: np.ndarray | None = None) -> list[tuple[int, np.ndarray]]:
    """(depth, ranks) of the suffixes at ``starts`` (all by default) for 8, more, and ``WINDOW`` bytes:
    equal ranks are equal prefixes, and ranks are in the order of the prefixes. Bytes beyond the end count as 0."""
    starts = np.arange(len(text)) if starts is None else starts
    n = len(starts)
    key = np.concatenate([text, np.zeros(WINDOW + 7, np.uint8)]).astype(np.uint64)
    for step in (1, 2, 4):
        key = (key[:-step] << np.uint64(8 * step)) | key[step:]
    order = np.argsort(key[starts])
    value = key[starts[order]]
    fresh = np.r_[True, value[1:] != value[:-1]][:n]
    begin = np.flatnonzero(fresh)
    rank = np.empty(n, np.int32)
    rank[order] = begin[np.cumsum(fresh) - 1]
    depth, found = 8, [(8, rank)]
    # The suffixes in groups of two and more, group by group; the others are settled.
    many = np.diff(np.r_[begin, n]) > 1
    open_at = order[many[np.cumsum(fresh) - 1]]
    most = (64 - max(1, n).bit_length()) // 8
    while depth < WINDOW:
        step = min(most, WINDOW - depth)
        rank = rank.copy()
        if len(open_at):
            group = rank[open_at]
            pair = (group.astype(np.uint64) << np.uint64(8 * step)) | (key[starts[open_at] + depth] >> np.uint64(64 - 8 * step))
            order = np.argsort(pair)
            open_at, group, pair = open_at[order], group[order], pair[order]
            fresh = np.r_[True, pair[1:] != pair[:-1]]
            begin, of = np.flatnonzero(fresh), np.cumsum(fresh) - 1
            # A group keeps its ranks' range: members move up by their place in it.
            top = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            rank[open_at] = group + begin[of] - np.repeat(top, np.diff(np.r_[top, len(group)]))
            open_at = open_at[(np.diff(np.r_[begin, len(pair)]) > 1)[of]]
        depth += step
        found.append((depth, rank))
    return found


def common_prefixes(suffixes: np.ndarray, ranks: list[tuple[int, np.ndarray]], text: np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
    """Common bytes, up to ``WINDOW``, of each suffix with the one before it in ``suffixes``.

    ``suffixes`` are places in ``starts`` (in the text by default), where at least ``WINDOW`` bytes follow.
    """
    left, right = suffixes[:-1], suffixes[1:]
    common = np.zeros(len(left), np.int64)
    same = np.arange(len(left))
    for depth, rank in ranks:
        same = same[rank[left[same]] == rank[right[same]]]
        common[same] = depth
    if starts is not None:
        left, right = starts[left], starts[right]
    same = np.flatnonzero(common < WINDOW)
    for _ in range(7):  # what is left is less than the largest stride
        same = same[text[left[same] + common[same]] == text[right[same] + common[same]]]
        common[same] += 1
    return np.r_[0, common]


def keepers(stretches: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all strings of all stretches, in a row: their stretch, their start in it, and the smallest doc that has the string.

    ``docs`` is the smallest doc of each (different) stretch.
    """
    text = np.frombuffer(b"".join(stretches), np.uint8)
    sizes = np.array([len(s) for s in stretches])
    strings = sizes - WINDOW + 1
    of = np.repeat(np.arange(len(stretches)), strings)
    inside = np.arange(strings.sum()) - np.repeat(np.cumsum(strings) - strings, strings)
    start = (np.cumsum(sizes) - sizes)[of] + inside
    ranks = suffix_ranks(text, start)
    order = np.argsort(ranks[-1][1])
    common = common_prefixes(order, ranks, text, start)
    fresh = np.flatnonzero(common < WINDOW)
    lowest = np.minimum.reduceat(docs[of][order], fresh)
    out = np.empty(len(order), np.int64)
    out[order] = np.repeat(lowest, np.diff(np.r_[fresh, len(order)]))
    return of, inside, out


#: The packed columns and their types.
_COLUMNS = {"docs": "<i8", "groups": "<i8", "rows": "<u4", "starts": "<u4", "sizes": "<u2", "split": "<u1", "parts": "<u1"}


def _planes(values: np.ndarray) -> bytes:
    """All first bytes, all second bytes, ...: what the shuffle's compression takes well."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _from_planes(raw: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _steps(keys: np.ndarray) -> bytes:
    """Ascending 32-bit keys as planes of their differences: the first bytes are mostly zero."""
    return _planes(np.diff(keys.astype("<u4"), prepend=np.zeros(1, "<u4")))


def _from_steps(raws) -> np.ndarray:
    """The keys of all of ``raws`` in a row."""
    return np.concatenate([np.cumsum(_from_planes(raw, "<u4"), dtype=np.uint32) for raw in raws])


def _unpack(pdf: pd.DataFrame) -> list[np.ndarray]:
    columns = [np.concatenate([_from_planes(raw, kind) for raw in pdf[name]]) for name, kind in _COLUMNS.items()]
    return [c.astype(np.int64) for c in columns]


def _packed(route: np.ndarray, docs, groups, rows, starts, sizes, split, parts, pieces: list[bytes]) -> pd.DataFrame:
    """One row per route, in the order given within each."""
    order = np.argsort(route, kind="stable")
    cuts = np.flatnonzero(np.r_[True, route[order][1:] != route[order][:-1]]) if len(order) else np.empty(0, int)
    given = (docs, groups, rows, starts, sizes, split, parts)
    arrays = [np.asarray(x)[order].astype(kind) for x, kind in zip(given, _COLUMNS.values())]
    out = []
    for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
        text = b"".join([pieces[i] for i in order[s:e].tolist()])
        out.append((int(route[order[s]]), *(_planes(x[s:e]) for x in arrays), text))
    return pd.DataFrame(out, columns=["route", *_COLUMNS, "text"])


def _spans(groups: np.ndarray, rows: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pd.DataFrame:
    """Spans packed by group: the span's end stands in ``docs``."""
    none = np.zeros(len(rows))
    return _packed(-1 - groups, ends, groups, rows, starts, none, none, none, [b""] * len(rows))


def _settle(pdf: pd.DataFrame, shards: int, final: bool) -> pd.DataFrame:
    """A shard's spans, and (unless final) the strings that split anchors keep."""
    docs, groups, rows, starts, sizes, split, parts = _unpack(pdf)
    text = b"".join(pdf["text"])
    ends = np.cumsum(sizes)
    if not final:
        gone, kept, strings = [], [], []
        for part in np.unique(parts):
            at = np.flatnonzero(parts == part)
            pieces = [text[e - n : e] for e, n in zip(ends[at].tolist(), sizes[at].tolist())]
            covered, again = _settle_part(docs[at], split[at], pieces)
            owner, opens, closes = covered
            gone.append((at[owner], opens, closes))
            owner, place = again
            kept.append((at[owner], place))
            strings += [pieces[i][s : s + WINDOW] for i, s in zip(owner.tolist(), place.tolist())]
        o, opens, closes = map(np.concatenate, zip(*gone))
        spans = _spans(groups[o], rows[o], starts[o] + opens, starts[o] + closes)
        if not strings:
            return spans
        o, place = map(np.concatenate, zip(*kept))
        same = np.ones(len(o))
        more = _packed(_shards_of(strings, shards), docs[o], groups[o], rows[o], starts[o] + place, same * WINDOW, same, same * 0, strings)
        return pd.concat([spans, more])
    which, different, lowest = _different([text[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist())], docs)
    # Sorted runs of single strings, merged by binary search.
    runs = np.array(different, dtype=object)
    merged = np.sort(runs)
    keeper = np.empty(len(merged), np.int64)
    keeper[np.searchsorted(merged, runs)] = lowest
    covered = keeper[np.searchsorted(merged, runs)][which] < docs
    return _spans(groups[covered], rows[covered], starts[covered], starts[covered] + WINDOW)


def _different(pieces: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(which, different, lowest): the different pieces, the one that each piece is, and the smallest doc of each."""
    number: dict[bytes, int] = {}
    which = np.array([number.setdefault(p, len(number)) for p in pieces])
    lowest = np.full(len(number), np.iinfo(np.int64).max)
    np.minimum.at(lowest, which, docs)
    return which, list(number), lowest


def _settle_part(docs: np.ndarray, split: np.ndarray, pieces: list[bytes]) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """(piece, start, end) of the runs of bytes that go, and (piece, start) of the strings that split anchors keep."""
    which, different, lowest = _different(pieces, docs)
    _, _, keeper = keepers(different, lowest)
    strings = np.array([len(s) for s in different]) - WINDOW + 1
    first = np.cumsum(strings) - strings
    # All strings of all stretches, those that repeat included.
    each = strings[which]
    owner = np.repeat(np.arange(len(which)), each)
    place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    keeps = keeper[first[which][owner] + place]
    covered = keeps < docs[owner]
    opens = np.flatnonzero(covered & ~(np.r_[False, covered[:-1]] & np.r_[False, owner[1:] == owner[:-1]]))
    closes = np.flatnonzero(covered & ~(np.r_[covered[1:], False] & np.r_[owner[1:] == owner[:-1], False]))
    again = np.flatnonzero(~covered & (split[owner] > 0))
    return (owner[opens], place[opens], place[closes] + WINDOW), (owner[again], place[again])


def _shards_of(strings: list[bytes], shards: int, at_once: int = 10_000) -> np.ndarray:
    """The shard of each string of ``WINDOW`` bytes, by the grams at its ends."""
    out = []
    for k in range(0, len(strings), at_once):
        h = gram_hashes(np.frombuffer(b"".join(strings[k : k + at_once]), np.uint8))
        out.append((h[::WINDOW] ^ (h[WINDOW - GRAM :: WINDOW] * np.uint64(_MIX[1]))) % np.uint64(shards))
    return np.concatenate(out).astype(np.int64)


def remove_repeats(docs: DataFrame, group_bytes: int = 4 << 20, shard_bytes: int = 8 << 20) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: the byte spans removed, and the bytes that stay.

    Null text counts as empty. Rows without an id are left whole and remove
    nothing elsewhere. Rows that share an id are documents of one id: neither
    is smaller, so they leave each other whole. An empty table gives no rows;
    extra columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_groups = max(least, group_count(spark, total, group_bytes))
    shards = max(least, group_count(spark, total, shard_bytes))
    # Rows without an id are spread by their text.
    group = F.pmod(F.coalesce(F.xxhash64("doc_id"), F.xxhash64("text")), F.lit(n_groups))
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select("doc_id", "text", group.alias("g"))

    def ordered(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.sort_values(["doc_id", "text"], ignore_index=True)

    def with_id(pdf: pd.DataFrame):
        for row, (doc, raw) in enumerate(zip(pdf["doc_id"], pdf["text"])):
            if not pd.isna(doc):
                yield row, int(doc), raw

    def keys_of(shard: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Where a half's key is counted, and its hash there."""
        return ((shard // np.uint64(COUNTED)) << np.uint64(32)) | (key & _LOW)

    def shard_of(value: np.ndarray) -> np.ndarray:
        return (value >> np.uint64(32)) % np.uint64(shards)

    def fingerprints(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        """The group's keys by counting shard, with the number of documents that hold each."""
        values, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for _, doc, raw in with_id(ordered(pdf)):
            first, turn, last, value, left, right = halves(np.frombuffer(raw, np.uint8))
            shard = shard_of(value)
            found = np.concatenate([keys_of(shard, left)[turn > first], keys_of(shard, right)[last >= turn]])
            values.append(found)
            owners.append(np.full(len(found), doc))
        value, owner = np.concatenate(values), np.concatenate(owners)
        order = np.argsort(value, kind="stable")  # documents come in the order of their ids
        value, owner = value[order], owner[order]
        once = np.r_[True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])][: len(value)]
        value, count = np.unique(value[once], return_counts=True)
        shard = (value >> np.uint64(32)).astype(np.int64)
        count = np.minimum(count, 65535).astype(np.uint16)
        cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]][: len(shard)])
        out = [(int(shard[s]), int(key[0]), _steps(value[s:e] & _LOW), _planes(count[s:e])) for s, e in zip(cuts, [*cuts[1:], len(shard)])]
        release()
        return pd.DataFrame(out, columns=["shard", "g", "anchors", "counts"])

    def repeated(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        """Back to each group: its keys that several documents hold, and over how many shards to split them."""
        value = _from_steps(pdf["anchors"])
        count = np.concatenate([_from_planes(raw, "<u2") for raw in pdf["counts"]])
        group = np.repeat(pdf["g"].to_numpy(), [len(a) // 4 for a in pdf["anchors"]])
        order = np.argsort(value)
        value, count, group = value[order], count[order].astype(np.int64), group[order]
        cuts = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
        held = np.repeat(np.add.reduceat(count, cuts), np.diff(np.r_[cuts, len(value)]))
        order = np.flatnonzero(held > 1)
        order = order[np.argsort(group[order], kind="stable")]
        group, value, ways = group[order], value[order], -(-held[order] // MOST_STRETCHES)
        cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]][: len(group)])
        out = [(int(group[s]), int(key[0]), _steps(value[s:e]), _planes(ways[s:e].astype("<u4"))) for s, e in zip(cuts, [*cuts[1:], len(group)])]
        release()
        return pd.DataFrame(out, columns=["g", "shard", "anchors", "ways"])

    def stretches(key: tuple, pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(known) or not len(pdf):
            return _spans(*(np.empty(0, np.int64) for _ in range(4)))
        shard = np.repeat(known["shard"].to_numpy(), [len(a) // 4 for a in known["anchors"]]).astype(np.uint64)
        hot = (shard << np.uint64(32)) | _from_steps(known["anchors"])
        hot_ways = np.concatenate([_from_planes(raw, "<u4") for raw in known["ways"]])
        order = np.argsort(hot)
        hot, hot_ways = hot[order], hot_ways[order].astype(np.int64)

        def ways_of(mine: np.ndarray, there: np.ndarray) -> np.ndarray:
            at = np.minimum(np.searchsorted(hot, mine), len(hot) - 1)
            return np.where(there & (hot[at] == mine), hot_ways[at], 0)

        g = int(key[0])
        ids, raws, runs = {}, {}, []
        for row, doc, raw in with_id(ordered(pdf)):
            first, turn, last, value, left, right = halves(np.frombuffer(raw, np.uint8))
            shard = shard_of(value)
            l_ways, r_ways = ways_of(keys_of(shard, left), turn > first), ways_of(keys_of(shard, right), last >= turn)
            # One stretch where both halves go the same ways, else one for each that is held elsewhere.
            both = l_ways == r_ways
            for there, s, e, n in (((l_ways > 0) & both, first, last, l_ways), ((l_ways > 0) & ~both, first, turn - 1, l_ways), ((r_ways > 0) & ~both, turn, last, r_ways)):
                at = np.flatnonzero(there)
                if len(at):
                    part = (value[at] & _LOW) % np.uint64(PARTS)
                    runs.append(np.stack([np.full(len(at), row), s[at], e[at] + WINDOW, n[at], shard[at].astype(np.int64), part.astype(np.int64)]))
                    ids[row], raws[row] = doc, raw
        rows, starts, ends, ways, shard, parts = np.concatenate(runs, 1) if runs else np.empty((6, 0), np.int64)
        seen: dict[bytes, int] = {}
        sent, done, pieces = [], [], []
        for k, (row, s, e) in enumerate(zip(rows.tolist(), starts.tolist(), ends.tolist())):
            piece, doc = raws[row][s:e], ids[row]
            # Documents come in the order of their ids.
            if seen.setdefault(piece, doc) < doc:
                done.append(k)
            else:
                sent.append(k)
                pieces.append(piece)
        at = np.array(sent, np.int64)
        owners = np.array([ids[row] for row in rows[at].tolist()], np.int64)
        route = shard[at] + shards * (g % np.maximum(ways[at], 1))
        out = _packed(route, owners, np.full(len(at), g), rows[at], starts[at], ends[at] - starts[at], ways[at] > 1, parts[at], pieces)
        if done:
            at = np.array(done)
            out = pd.concat([out, _spans(np.full(len(at), g), rows[at], starts[at], ends[at])])
        release()
        return out

    def settle(final: bool):
        def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            if key[0] < 0:
                return pdf
            found = _settle(pdf, shards, final)
            release()
            return found

        return run

    def cut(key: tuple, pdf: pd.DataFrame, spans: pd.DataFrame) -> pd.DataFrame:
        pdf = ordered(pdf)
        by_row: dict[int, list[tuple[int, int]]] = {}
        if len(spans):
            ends, _, rows, starts, *_ = _unpack(spans)
            for row, s, e in zip(rows.tolist(), starts.tolist(), ends.tolist()):
                by_row.setdefault(row, []).append((s, e))
        out = []
        for row, (doc, raw) in enumerate(zip(pdf["doc_id"], pdf["text"])):
            merged: list[list[int]] = []
            for s, e in sorted(by_row.get(row, [])):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            edges = [0, *(x for span in merged for x in span), len(raw)]
            kept = b"".join([raw[s:e] for s, e in zip(edges[::2], edges[1::2])])
            found = [{"start": s, "length": e - s} for s, e in merged]
            out.append((None if pd.isna(doc) else int(doc), len(raw), found, kept))
        return pd.DataFrame(out, columns=["doc_id", "n_bytes", "spans", "kept"]).astype({"doc_id": "Int64"})

    held = dealt.groupBy("g").applyInPandas(fingerprints, "shard long, g long, anchors binary, counts binary")
    known = held.groupBy("shard").applyInPandas(repeated, "g long, shard long, anchors binary, ways binary")
    sent = dealt.groupBy("g").cogroup(known.groupBy("g")).applyInPandas(stretches, PACKED)
    once = sent.groupBy("route").applyInPandas(settle(final=False), PACKED)
    twice = once.groupBy("route").applyInPandas(settle(final=True), PACKED)
    spans = twice.withColumn("g", -1 - F.col("route"))
    result = "doc_id long, n_bytes long, spans array<struct<start:long,length:long>>, kept binary"
    return dealt.groupBy("g").cogroup(spans.groupBy("g")).applyInPandas(cut, result)
