"""N-gram Jaccard self-join by T-occurrence search.

A document's set has its distinct word shingles. Two documents link when ``100 * common >= percent * union``; so a set of
n shares at least T(n) = percent of n members with any set to which it links, and a document's partners are those that
occur T times or more among its inverted lists (a list: the documents that have one shingle).

DivideSkip sets the T - 1 longest of a document's lists aside as long ones; a partner is in at least one of the others,
the short ones. Three steps apply it, each exact:

1. Of each set only the first members in the order of their hashes are dealt out by shingle: so many that a partner has
   at least ``SHARE`` percent of n of them too. Documents with fewer lists that anyone else is in have no partner and go.
2. Those left deal out whole sets. With the true length of each list a document needs T lists with another document in
   them; of these it keeps all but the T - 1 longest. A group has the documents of all kept lists with the same first one.
3. A group's sets meet in one task. One document, the hub, searches the inverted lists of all others: short lists are
   merged by a heap, what is found is probed in the long ones by binary search, and whoever reaches T is looked at with its
   own size (``divide_skip``). What x differs by from the hub is D(x). Of two documents that link and don't both link to the
   hub, D(x) and D(y) share a number of members that follows from the sizes and is above 0 (``needed``): a T-occurrence
   problem again, with small sets, by which the documents reached search for those not reached yet. Only the links along
   which documents are reached are kept, not all pairs.

Groups of more than ``BLOCK`` documents are not brought to one task. Their hub searches the lists of the others in as many
places as needed, and the differences are dealt out by their members: documents without ``needed`` live lists go, again
and again. The differences of those left meet in one task, or where they are more than ``TOLD_BLOCK`` part by part, any
two parts in a task of their own, and are searched as in step 3. There is one such round; differences from a second hub
would be larger and tell less, as all of a group share most of what that hub has changed.

Cases: null and empty texts have no set and link to nothing; they are their own component, with 0 shingles. Equal sets
are one class and only its first document takes part. Texts of any length are read whole. A null identifier ranks before
all others. Rows of one identifier with different texts are documents of their own; repeated rows are returned as often
as they come. Extra columns are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fresh, tidy
from .counters import counter_of, long_keys
from .shingles import WIDTH, WordHashes, mix, shingle_set

PERCENT = 80
#: Of the first members of a set, partners have so many percent of its size in common.
SHARE = 10
#: Groups of at most so many documents, and so many members in all sets together, are searched in one task.
BLOCK, BLOCK_MEMBERS = 1024, 1 << 21
#: Differences of at most so many documents are searched in one task.
TOLD_BLOCK = 4096
#: Groups of more documents than this have their lists as arrays.
ARRAYS = 128
#: About so many documents are searched by a hub in one task.
TOGETHER = 64
#: Lists that may have more than so many rows are counted by partial aggregation.
HOT = 4096
#: Broadcasts of identifiers up to so many; beyond, a shuffle.
BROADCAST_IDS = 1_000_000


def least_common(n: int, percent: int = PERCENT) -> int:
    """Fewest members that a set of ``n`` shares with any set to which it links."""
    return -(-percent * n // 100)


def links(n: int, m: int, common: int, percent: int = PERCENT) -> bool:
    return 100 * common >= percent * (n + m - common)


def first_members(n: int, percent: int = PERCENT) -> tuple[int, int]:
    """How many first members of a set of ``n`` are dealt out, and how many of these any partner has in its own.

    Of the common members at most T - s lie beyond the first n - T + s, so s of them lie within; a partner's share s is
    that of its own size, which is at least ``percent`` of n.
    """
    share = lambda size: max(1, -(-SHARE * size // 100))
    t = least_common(n, percent)
    return min(n, n - t + share(n)), min(share(t), n)


def divide_skip(lists: list[list[int]], t: int, long_lists: int) -> dict[int, int]:
    """Members of at least ``t`` of the sorted lists, with how many.

    The ``long_lists`` longest are set aside; the short ones are merged by a heap, and what is in at least
    ``t - long_lists`` of them is looked up in the long ones by binary search until it can't reach ``t`` any more.
    """
    ordered = sorted(lists, key=len)
    split = max(0, len(ordered) - long_lists)
    short, long = ordered[:split], ordered[split:]
    heap = [(x[0], i, 0) for i, x in enumerate(short) if x]
    heapq.heapify(heap)
    found = {}
    while heap:
        member, count = heap[0][0], 0
        while heap and heap[0][0] == member:
            _, i, k = heap[0]
            count += 1
            if k + 1 < len(short[i]):
                heapq.heapreplace(heap, (short[i][k + 1], i, k + 1))
            else:
                heapq.heappop(heap)
        if count < t - len(long):
            continue
        for left, x in zip(range(len(long), 0, -1), long, strict=True):
            if count + left < t:
                break
            k = bisect_left(x, member)
            count += k < len(x) and x[k] == member
        if count >= t:
            found[member] = count
    return found


def divide_skip_arrays(lists: list[np.ndarray], t: int, long_lists: int, n: int) -> dict[int, int]:
    """As ``divide_skip``, for sorted arrays of members below ``n``: short lists are merged by counting, long ones probed for all that is still open at once."""
    ordered = sorted(filter(len, lists), key=len)
    split = max(0, len(ordered) - long_lists)
    short, long = ordered[:split], ordered[split:]
    if not short:
        return {}
    count = np.bincount(np.concatenate(short), minlength=n)
    member = np.flatnonzero(count >= max(1, t - len(long)))
    count = count[member]
    for left, x in zip(range(len(long), 0, -1), long, strict=True):
        open_ = count + left >= t
        if not open_.all():
            member, count = member[open_], count[open_]
        if not len(member):
            break
        at = np.minimum(np.searchsorted(x, member), len(x) - 1)
        count = count + (x[at] == member)
    enough = count >= t
    return dict(zip(member[enough].tolist(), count[enough].tolist(), strict=True))


# ---- one task


def inverted(sets: list[np.ndarray]) -> tuple[list[np.ndarray], list[list[int]]]:
    """Lists of the members that two sets or more have, and for each set the numbers of its lists."""
    members = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(members, kind="stable")
    members, owner = members[order], owner[order]
    edges = np.flatnonzero(np.diff(members, prepend=members[:1] ^ np.uint64(1), append=members[-1:] ^ np.uint64(1)))
    begin, size = edges[:-1], np.diff(edges)
    lists, of = [], [[] for _ in sets]
    for a, n in zip(begin[size > 1].tolist(), size[size > 1].tolist(), strict=True):
        one = owner[a : a + n]
        for d in one.tolist():
            of[d].append(len(lists))
        lists.append(one)
    return lists, of


def search_hub(hub: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> list[bool]:
    """Whether each set links to the hub's."""
    t = least_common(len(hub), percent)
    lists: list[list[int]] = [[] for _ in range(len(hub))]
    for d, s in enumerate(sets):
        at = np.minimum(np.searchsorted(hub, s), len(hub) - 1)
        for k in at[hub[at] == s].tolist():
            lists[k].append(d)
    common = divide_skip([x for x in lists if x], t, t - 1)
    return [links(len(hub), len(s), common.get(d, 0), percent) for d, s in enumerate(sets)]


def needed(size: int, c: int, m: int, percent: int = PERCENT) -> tuple[int, int]:
    """What D of a set of ``m`` (``size`` members, against a hub of ``c``) shares at least with the D of a set to which it links:
    if that one doesn't link to the hub, and if it does but this one doesn't.

    Two sets that link differ by at most free = (100 - percent) / (100 + percent) of their sizes' sum, sets that don't by more.
    So with x of m and z of r: 2 |D(x) D(z)| = |D(x)| + |D(z)| - |x z differ| >= size + |D(z)| - free (m + r). If z doesn't link
    to the hub, |D(z)| > free (c + r). In any case |D(z)| >= size - free (m + r).
    """
    low, high = 100 - percent, 100 + percent
    far = (size * high + (c - m) * low) // (2 * high) + 1
    far = max(far, size - int((m + 100 * m / percent) * low / high + 1e-9))
    near = size - int((m + min(100 * m, 100 * c) / percent) * low / high + 1e-9)
    return max(1, far), max(1, near)


def search_group(ids: list[int], sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that connect what all links among the documents connect.

    The hub, whose lists are longest for its size, searches all others. What it doesn't reach is searched for by those
    reached, and so on, in the inverted lists of the differences D from the hub; lists hold only what is not reached yet.
    """
    lists, of = inverted(sets)
    size = [len(s) for s in sets]
    hub = max(range(len(ids)), key=lambda d: (sum(len(lists[k]) for k in of[d]) / size[d], -d))
    rest = [d for d in range(len(ids)) if d != hub]
    near = search_hub(sets[hub], [sets[d] for d in rest], percent)
    found = [(ids[hub], ids[d]) for d, link in zip(rest, near, strict=True) if link]
    left = [True] * len(ids)
    left[hub] = False
    for d, link in zip(rest, near, strict=True):
        left[d] = not link
    if not any(left):
        return found
    differences = [np.setxor1d(sets[hub], s, assume_unique=True) for s in sets]
    far = [needed(len(d), size[hub], n, percent)[0] for d, n in zip(differences, size, strict=True)]
    return found + search_differences([ids[d] for d in rest], [differences[d] for d in rest], [size[d] for d in rest], near, [far[d] for d in rest], percent)


def search_differences(ids: list[int], differences: list[np.ndarray], size: list[int], linked: list[bool], far: list[int], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that connect what all links connect in which a document has a part that isn't linked to the hub.

    differences: from the hub; size: of the sets; far: what ``needed`` tells first.
    """
    lists, of = inverted(differences)
    left = ~np.array(linked, bool)
    held = remaining = int(left.sum())
    arrays = len(ids) > ARRAYS
    free = lambda lists: [x[left[x]] if arrays else [d for d in x if left[d]] for x in lists]
    lists = free(lists if arrays else [x.tolist() for x in lists])
    queue, found = np.flatnonzero(~left).tolist(), []
    for start in [None, *range(len(ids))]:
        if start is not None and left[start]:
            queue, left[start], remaining = [start], False, remaining - 1
        while queue and remaining:
            if 2 * remaining <= held:  # lists are freed of those reached each time these halve
                lists, held = free(lists), remaining
            q = queue.pop()
            t = far[q]
            own = [x for x in map(lists.__getitem__, of[q]) if len(x)]
            if len(own) < t:
                continue
            for d, shared in (divide_skip_arrays(own, t, t - 1, len(ids)) if arrays else divide_skip(own, t, t - 1)).items():
                if left[d]:
                    differ = len(differences[q]) + len(differences[d]) - 2 * shared
                    if links(size[q], size[d], (size[q] + size[d] - differ) // 2, percent):
                        left[d], remaining = False, remaining - 1
                        found.append((ids[q], ids[d]))
                        queue.append(d)
    return found


# ---- rows


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    flat = np.concatenate(parts).view(np.int64) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _info(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """id, n, digest of the set, and the first members with how many of them a partner has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        memo = WordHashes()
        for whole in batches:
            for k in range(0, whole.num_rows, 1000):
                batch = whole.slice(k, 1000)
                sets = [shingle_set(t.as_py(), memo, width) for t in batch.column(1)]
                size = [first_members(len(s), percent) if len(s) else (0, 0) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([x for _, x in size], pa.int64()), _lists([s[:p] for s, (p, _) in zip(sets, size, strict=True)])],
                    names=["id", "n", "digest", "need", "keys"],
                )

    return docs.mapInArrow(run, "id long, n long, digest binary, need long, keys array<long>")


def _whole_sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        memo = WordHashes()
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                batch = whole.slice(k, 500)
                sets = [shingle_set(t.as_py(), memo, width) for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([least_common(len(s), percent) for s in sets], pa.int64()), _lists(sets)], names=["id", "n", "need", "keys"])

    return docs.select("id", "text").mapInArrow(run, "id long, n long, need long, keys array<long>")


def _dealt(held: DataFrame, more: list[str], long_ones: np.ndarray) -> DataFrame:
    """(id, ``more`` columns, key, many) of each key of ``held``; many: its list may be too long for one task by the counters
    (a key's counter is at least the length of its list)."""
    flags = held.sparkSession.sparkContext.broadcast(np.packbits(long_ones))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        long = np.unpackbits(flags.value).astype(bool)
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                batch = whole.slice(k, 500)
                keys = batch.column(batch.num_columns - 1)
                flat = keys.flatten()
                of = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(keys), 0).to_numpy(zero_copy_only=False))
                many = long[counter_of(flat.to_numpy(zero_copy_only=False))]
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(pa.array(of)) for i in range(batch.num_columns - 1)), flat, pa.array(many)], names=["id", *more, "key", "many"])

    picked = held.select("id", *more, "keys")
    return picked.mapInArrow(deal, ", ".join(f"{c} {t}" for c, t in picked.dtypes if c != "keys") + ", key long, many boolean")


def _with_list(rows: DataFrame, any_many: bool, **of_list) -> DataFrame:
    """``rows`` with aggregates of their list: where its rows meet, or for long lists by partial aggregation and a join."""
    at = Window.partitionBy("key")
    few = rows.where("not many").withColumns({c: f.over(at) for c, f in of_list.items()})
    if not any_many:
        return few
    sums = rows.where("many").groupBy("key").agg(*[f.alias(c) for c, f in of_list.items()])
    return few.unionByName(rows.where("many").join(sums.hint("shuffle_merge"), "key"))


def _live(held: DataFrame, hot: int) -> DataFrame:
    """(id, key, size) of the rows in lists of two documents or more."""
    long_ones = long_keys(held.select("keys"), hot)
    return _with_list(_dealt(held, [], long_ones), bool(long_ones.any()), size=F.count("*")).where("size > 1").select("id", "key", "size")


#: Times that documents without enough live lists are taken out of the lists.
_PEEL = 3


def _live_differences(held: DataFrame, hot: int) -> DataFrame:
    """The rows of ``held`` that can still matter. held: id, a (hub), n, link, far, near, keys.

    A partner shares ``far`` lists if it doesn't link to the hub; one that does shares ``near`` lists with a document that
    doesn't, and nothing has to be found for two that do. Documents with fewer such lists go, and with them what made
    others' lists live; so again.
    """
    long_ones = long_keys(held.select("keys"), hot)
    own = ["id", "a"]
    for k in range(_PEEL):
        rows = _with_list(_dealt(held, ["a", "link"], long_ones), bool(long_ones.any()), size=F.count("*"), linked=F.count_if("link"))
        others = F.col("size") - F.col("linked") - (~F.col("link")).cast("long")
        live = rows.select(*own, "key", "size", (others > 0).alias("u"), (~F.col("link") & (F.col("linked") > 0)).alias("l")).where("u or l")
        counted = live.groupBy(*own).agg(F.count_if("u").alias("us"), F.count_if("l").alias("ls"))
        far, near = F.col("us") >= F.col("far"), ~F.col("link") & (F.col("ls") >= F.col("near"))
        held = cut(held.join(counted, own).where(far | near).select(*own, "n", "link", "far", "near", "keys"), forget_size=True)
        if held.isEmpty():
            break
    return held


def _search_differences(held: DataFrame, percent: int, told_block: int) -> DataFrame:
    """(a, b): links among the rows of ``held`` (as in ``_live_differences``) of the same hub."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        at, rows = None, []
        for batch in batches:
            for g, i, j, *row, keys in zip(*(batch.column(c).to_pylist() for c in range(7)), batch.column(7), strict=True):
                if (g, i, j) != at:
                    yield from told(rows)
                    at, rows = (g, i, j), []
                rows.append((*row, np.sort(keys.values.to_numpy(zero_copy_only=False).view(np.uint64))))
        yield from told(rows)

    def told(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if rows:
            ids, size, linked, far, differences = map(list, zip(*rows, strict=True))
            if not all(linked) and (found := search_differences(ids, differences, size, linked, far, percent)):
                yield _batch(found, pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    sizes = held.groupBy("a").agg(F.count("*").alias("rows"), F.sum(F.size("keys")).alias("members"))  # a row for each group of more than BLOCK documents
    parts = F.when((F.col("rows") > told_block) | (F.col("members") > BLOCK_MEMBERS), F.greatest(F.lit(2), F.ceil(2 * F.col("rows") / told_block), F.ceil(2 * F.col("members") / BLOCK_MEMBERS))).otherwise(1)
    placed = held.join(F.broadcast(sizes.select("a", parts.cast("int").alias("parts"))), "a").withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts").cast("long")).cast("int"))
    # a part meets each other one; a single part is alone
    others = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(F.array_except(F.sequence(F.lit(0), F.col("parts") - 1), F.array("own")))
    sent = placed.withColumn("other", F.explode(others)).select("a", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "n", "link", "far", "keys")
    return sent.repartition("a", "i", "j").sortWithinPartitions("a", "i", "j", "id").mapInArrow(solve, "a long, b long")


def _short(held: DataFrame, live: DataFrame) -> DataFrame:
    """(id, n, weight, key): the live lists but the need - 1 longest of the documents that have ``need`` of them.

    Two documents that link share ``need`` live lists; the shortest of these is kept by both. weight: how long a
    document's lists are for its size.
    """
    one = live.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("size", "key"))).alias("m"), F.sum("size").alias("sum"))  # as many as the set has members
    enough = one.join(held.select("id", "n", "need"), "id").where(F.size("m") >= F.col("need"))
    kept = F.slice("m", F.lit(1), (F.size("m") - F.col("need") + 1).cast("int"))
    return enough.select("id", "n", (F.col("sum") / F.col("need")).alias("weight"), F.explode(F.transform(kept, lambda x: x["key"])).alias("key"))


def _only(df: DataFrame, ids: DataFrame, broadcast_ids: int, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose id is (or is not) among ``ids``, which are broadcast if they are few."""
    few = ids.count() <= broadcast_ids
    return df.join(F.broadcast(ids) if few else ids.hint("shuffle_merge"), "id", how)


_SENT = "g long, place int, kind int, id long, set binary"
_TOLD = "a long, b long, link boolean, n long, far long, near long, keys array<long>"


def _search(docs: DataFrame, wanted: DataFrame, width: int, percent: int, broadcast_ids: int) -> DataFrame:
    """wanted: id, g (group), place, places (above 0 for a hub), a row for each group of a document. Links found in groups; for documents of a hub's group also its D."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        memo = WordHashes()
        for whole in batches:
            for k in range(0, whole.num_rows, 200):
                rows = []
                for x in whole.slice(k, 200).to_pylist():
                    raw = shingle_set(x["text"], memo, width).tobytes()
                    for seat in x["seats"]:
                        places = seat["places"]
                        for g, place, kind in [(seat["g"], i, 0) for i in range(places)] or [(seat["g"], seat["place"], 1)]:
                            rows.append((g, place, kind, x["id"], raw))
                            if len(rows) >= 200:
                                yield _batch(rows, sent)
                                rows = []
                if rows:
                    yield _batch(rows, sent)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, kinds, ids, sets = None, [], [], []
        for batch in batches:
            for g, place, kind, key, raw in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("g", "place", "kind", "id", "set")), strict=True):
                at = (g.as_py(), place.as_py())
                if at != group:
                    if ids:
                        yield from _solved(kinds, ids, sets, percent)
                    group, kinds, ids, sets = at, [], [], []
                kinds.append(kind.as_py())
                ids.append(key.as_py())
                sets.append(np.frombuffer(raw.as_py(), np.uint64))
        if ids:
            yield from _solved(kinds, ids, sets, percent)

    sent = pa.schema([("g", pa.int64()), ("place", pa.int32()), ("kind", pa.int32()), ("id", pa.int64()), ("set", pa.binary())])
    few = wanted.count() <= broadcast_ids
    of = wanted.groupBy("id").agg(F.collect_list(F.struct("g", "place", "places")).alias("seats"))  # as many as a document has kept lists
    texts = docs.join(F.broadcast(of) if few else of.hint("shuffle_merge"), "id")
    return texts.mapInArrow(send, _SENT).repartition("g", "place").sortWithinPartitions("g", "place", "kind", "id").mapInArrow(solve, _TOLD)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _solved(kinds: list[int], ids: list[int], sets: list[np.ndarray], percent: int) -> Iterator[pa.RecordBatch]:
    told = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("link", pa.bool_()), ("n", pa.int64()), ("far", pa.int64()), ("near", pa.int64()), ("keys", pa.list_(pa.int64()))])
    if kinds[0]:
        rows = [(a, b, True, None, None, None, None) for a, b in search_group(ids, sets, percent)]
        if rows:
            yield _batch(rows, told)
        return
    hub, a = sets[0], ids[0]
    salt = np.uint64(xxhash.xxh3_64_intdigest(a.to_bytes(8, "little", signed=True)))
    near = search_hub(hub, sets[1:], percent)
    for k in range(0, len(near), 100):
        rows = []
        for b, s, link in zip(ids[1 + k : 101 + k], sets[1 + k : 101 + k], near[k : k + 100], strict=True):
            d = np.setxor1d(hub, s, assume_unique=True)
            far, near_ = needed(len(d), len(hub), len(s), percent)
            rows.append((a, b, link, len(s), far, near_, mix(d ^ salt).view(np.int64) if len(d) >= min(far, near_) else None))
        yield _batch(rows, told)


# ---- the whole search


def similar(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT, block: int = BLOCK, broadcast_ids: int = BROADCAST_IDS, hot: int = HOT, told_block: int = TOLD_BLOCK) -> tuple[DataFrame, DataFrame]:
    """(documents: id, n, twin) and (links: a, b): twin is the first document with the same set; links join twins.

    Identifiers must differ and not be null. The links connect exactly the documents that all links connect, but need not be all of them.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    info = cut(_info(docs, width, percent))
    members = info.where("n > 0").groupBy("digest").agg(F.min("id").alias("twin"), F.max("id").alias("most"))
    copies = cut(members.where("twin < most").drop("most"))
    few = copies.count() <= broadcast_ids
    nodes = info.select("id", "n", "digest").join(F.broadcast(copies) if few else copies.hint("shuffle_merge"), "digest", "left")
    nodes = cut(nodes.select("id", "n", F.coalesce("twin", "id").alias("twin")))
    alone = _only(info.where("n > 0").select("id", "need", "keys"), nodes.where("twin <> id").select("id"), broadcast_ids, "left_anti")
    live = _live(alone, hot).groupBy("id").agg(F.count("*").alias("live"))
    alive = cut(live.join(alone.select("id", "need"), "id").where("live >= need").select("id"))
    held = cut(_whole_sets(_only(docs, alive, broadcast_ids), width, percent))
    found = spark.createDataFrame([], "a long, b long")
    if held.isEmpty():
        return nodes, found
    short = cut(_short(held, _live(held, hot)), forget_size=True)
    # a group has the documents that share a list with its first one in that list; two that link share a kept list
    centres = short.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").drop("z")
    members = cut(short.join(centres, "key").groupBy("a", "id").agg(F.max("n").alias("n"), F.max("weight").alias("weight")), forget_size=True)
    if members.isEmpty():
        return nodes, found
    sizes = members.groupBy("a").agg(F.count("*").alias("size"), F.sum("n").alias("members"), F.max(F.struct("weight", (-F.col("id")).alias("less"))).alias("best"))
    large = (F.col("size") > block) | (F.col("members") > BLOCK_MEMBERS)
    hub, places = -F.col("best.less"), F.ceil(F.col("size") / TOGETHER).cast("int")
    seat = F.pmod(F.xxhash64("id"), places.cast("long")).cast("int")
    wanted = members.join(sizes, "a").select("id", F.col("a").alias("g"), F.when(large, seat).otherwise(0).alias("place"), F.when(large & (F.col("id") == hub), places).otherwise(0).alias("places"))
    checked = cut(_search(docs, cut(wanted), width, percent, broadcast_ids), forget_size=True)
    found = found.unionByName(checked.where("link").select("a", "b"))
    rest = checked.where("far is not null").select("a", F.col("b").alias("id"), "n", "link", "far", "near", "keys")
    # where all documents of a group link to its hub there is nothing left to find
    open_ = rest.where("not link").select("a").distinct()
    left = cut(rest.where("keys is not null").join(open_, "a", "left_semi").dropDuplicates(["id", "a"]), forget_size=True)
    if not left.isEmpty():
        left = _live_differences(left, hot)
        found = found.unionByName(cut(_search_differences(left, percent, told_block), forget_size=True))
    return nodes, found


def labels(edges: DataFrame) -> DataFrame:
    """(id, label) for the ends of ``edges`` (a, b): the smallest identifier that they reach.

    Each node takes the smallest label among its neighbours' and then its label's own label, until nothing changes.
    """
    both = cut(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), forget_size=True)
    named = cut(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("label")), forget_size=True)
    while True:
        near = both.join(named.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        step = named.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = step.select(F.col("id").alias("label"), F.col("label").alias("far"))
        moved = cut(step.join(jump, "label", "left").select("id", "old", F.least("label", F.coalesce("far", "label")).alias("label")), forget_size=True)
        changed = not moved.where("old <> label").isEmpty()
        named = moved.select("id", "label")
        if not changed:
            return named


def _grouped(df: DataFrame, id_col: str, text_col: str, **options) -> tuple[DataFrame, DataFrame | None]:
    """(rows: id, node, n, of) and the table of rows by node, where identifiers don't tell rows apart: id, node, text.

    of: the component's name. A node is an identifier, or where these repeat or are null a hash of identifier and text.
    """
    ids = df.select(F.col(id_col).cast("long").alias("id"))
    if ids.groupBy("id").count().where("count > 1 or id is null").isEmpty():
        nodes, edges = similar(df, id_col, text_col, **options)
        named, own = nodes.withColumn("node", F.col("id")), None
    else:
        text = F.col(text_col)
        own = df.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
        own = own.withColumn("node", F.xxhash64(F.col("id").isNull(), "id", F.col("text").isNull(), "text"))
        nodes, edges = similar(own.dropDuplicates(["node"]), "node", "text", **options)
        named = own.select("id", "node").join(nodes.withColumnRenamed("id", "node"), "node")
    reached = labels(edges).select(F.col("id").alias("twin"), F.col("label").alias("of"))
    return named.join(reached, "twin", "left").select("id", "node", "n", F.coalesce("of", "twin").alias("of")), own


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """id, n_shingles and component_id (the smallest identifier, null before all others) of every row."""
    rows, own = _grouped(df, id_col, text_col, **options)
    if own is None:  # components are named by their smallest identifier
        return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("of").alias("component_id"))
    rows = cut(rows)
    first = rows.groupBy("of").agg(F.min(F.struct("id")).alias("first"))
    return rows.join(first, "of").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("first.id").alias("component_id"))


def firsts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_ids: int = BROADCAST_IDS, **options) -> DataFrame:
    """The rows of ``df`` of which each component keeps one: that of the smallest identifier (null first), of several texts of one identifier the one of the smallest hash.

    Rows without words are no one's copy and stay, but rows that agree in identifier and text become one.
    """
    rows, own = _grouped(df, id_col, text_col, broadcast_ids=broadcast_ids, **options)
    if own is None:
        gone = cut(rows.where("id <> of").select("id"))
        key = fresh(df, "ngram_id")
        gone = gone.select(F.col("id").alias(key))
        return df.withColumn(key, F.col(id_col).cast("long")).join(F.broadcast(gone) if gone.count() <= broadcast_ids else gone.hint("shuffle_merge"), key, "left_anti").drop(key)
    rows = cut(rows)
    first = rows.groupBy("of").agg(F.min(F.struct("id", "node")).alias("first"))
    key = fresh(df, "ngram_node")
    kept = rows.join(first, "of").where(F.col("node") == F.col("first.node")).select(F.col("node").alias(key)).distinct()
    node = F.xxhash64(F.col(id_col).cast("long").isNull(), F.col(id_col).cast("long"), F.col(text_col).isNull(), F.col(text_col))
    return df.withColumn(key, node).join(kept.hint("shuffle_merge"), key, "left_semi").dropDuplicates([key]).drop(key)
