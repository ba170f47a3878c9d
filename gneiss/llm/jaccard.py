"""N-gram Jaccard join by set-relation skipping.

Every document is the set of its word shingles.  Equal sets are one class.  A class is listed in an
inverted index under its prefix, the shingles among which a partner of Jaccard similarity t must
share one; prefixes are ordered by (common in a bounded sample of documents, hash), so that shingles
of passages that many documents share come last and their lists stay short.

Index-level skipping: a list is sorted by set size, so the partners that sizes allow an entry are one
block of it, found by two searches; entries without such a block are skipped.  A set follows the set
that leads it in most of its lists (the least by hash in its block), its hub; lists are then read by
blocks of hubs, and give each set once for each hub that it can meet, not once for each partner.  Two
sets that link share a number of prefix shingles that follows from their sizes, so a set that met a hub
in fewer lists than any partner there would need stays away from it.

Answer-level skipping: the sets of a hub meet in one task, with their guests from other hubs, in blocks
of ``HELD`` sets or ``BYTES`` bytes.  The overlaps of a set with all others are counted from the lists of
its shingles, or follow from those of the most similar set that was answered before, by the lists of the
shingles in which the two differ.  Any two sets meet once, so links are counted exactly.

Defined results: null and empty texts have no shingles, link with nothing and are components of
their own; equal doc_ids are one document for the least id, each row with the size of its own set; a
null doc_id is never the least, and stays null as a component of its own; an empty table gives no rows;
columns other than the two named are ignored; ties (sets that lead equally often, equally similar bases)
go to the lesser hash, and change no result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.llm.components import connected_components
from gneiss.llm.shingles import mix, shingle_sets, texts
from gneiss.llm.storage import discard, materialize, release

#: A shingle is common if about so many documents of the table would list it, and 3 of the sample do.
COMMON = 32
#: Documents in the sample that finds common shingles, about.
SAMPLE = 25_000
#: Sets, and bytes of their shingles, of a block; two blocks at most meet in a task.
HELD, BYTES = 2048, 16 << 20
#: Answered sets from which the next one's answers may follow.
BASES = 16
#: Bits of the filter that keeps texts that meet nobody from being hashed again.
FILTER_BITS = 1 << 24
#: Pairs of an entry and a hub that are looked at side by side.
SPAN = 1 << 20


def prefix_size(n: np.ndarray | int, t100: int):
    """How many of ``n`` ordered shingles a partner of similarity t100/100 shares one with, at least."""
    return n - (t100 * n + 99) // 100 + 1


def needed(a, b, t100: int):
    """The least overlap of sets of sizes a and b that link: 100 * i >= t100 * (a + b - i)."""
    return (t100 * (a + b) + 99 + t100) // (100 + t100)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _fingerprints(flat: np.ndarray, bounds: np.ndarray, seed: int = 1) -> np.ndarray:
    """A hash of each set."""
    total = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(mix(flat + np.uint64(seed)), out=total[1:])
    return mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64))


def _sizes(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles and two hashes of the set."""

    def run(batches):
        for batch in texts(batches):
            flat, bounds = shingle_sets(batch.column(1), width)
            fp, check = _fingerprints(flat, bounds), _fingerprints(flat, bounds, 0x5BF03635)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(bounds)), _signed(fp), _signed(check)], ["doc_id", "n_shingles", "fp", "fp_check"])

    return docs.mapInArrow(run, "doc_id bigint, n_shingles bigint, fp bigint, fp_check bigint")


def _common(docs: DataFrame, rows: int, width: int, t100: int) -> np.ndarray:
    """Sorted hashes of shingles that many sampled documents have among their first by hash.

    At most SAMPLE documents' prefixes divided by 3: a bounded number, whatever the table's size.
    """
    share = min(1.0, SAMPLE / max(rows, 1))
    least = max(3, -(-COMMON * SAMPLE // max(rows, SAMPLE)))
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))

    def run(batches):
        for batch in texts(batches):
            flat, bounds = shingle_sets(batch.column(1), width)
            # twice the prefix: shingles that follow when common ones give way
            own = [flat[a : a + 2 * int(prefix_size(int(b - a), t100))] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            own = [x[: b - a] for x, a, b in zip(own, bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([_signed(np.concatenate(own))], ["token"])

    found = sample.mapInArrow(run, "token bigint").groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return np.sort(np.array([x[0] for x in found.select("token").collect()], dtype=np.int64).view(np.uint64))


def _postings(docs: DataFrame, common: np.ndarray, width: int, t100: int) -> DataFrame:
    """The index: token, fp, and size and prefix position in one number; a task lists a set once."""
    sent = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches):
        common, seen = sent.value, set()
        for batch in texts(batches):
            flat, bounds = shingle_sets(batch.column(1), width)
            n, fps = np.diff(bounds), _fingerprints(flat, bounds)
            late = np.zeros(len(flat), bool)
            if len(common):
                late = common[np.minimum(np.searchsorted(common, flat), len(common) - 1)] == flat
            if len(seen) > 500_000:
                seen.clear()
            tokens, own, places = [], [], []
            for i in np.flatnonzero(n):
                if int(fps[i]) in seen:
                    continue
                seen.add(int(fps[i]))
                s, f = flat[bounds[i] : bounds[i + 1]], late[bounds[i] : bounds[i + 1]]
                p = int(prefix_size(int(n[i]), t100))
                s = np.concatenate([s[~f], s[f]])[:p] if f.any() else s[:p]
                tokens.append(s)
                own.append(np.full(p, fps[i]))
                places.append((int(n[i]) << 32) + np.arange(p))
            if tokens:
                yield pa.RecordBatch.from_arrays([_signed(np.concatenate(tokens)), _signed(np.concatenate(own)), pa.array(np.concatenate(places).astype(np.int64))], ["token", "fp", "place"])

    return docs.mapInArrow(run, "token bigint, fp bigint, place bigint")


def _lists(batches):
    """Whole lists (token, and its entries' columns) from batches sorted by token; single entries go."""
    rest = None
    for batch in batches:
        columns = [x.to_numpy(zero_copy_only=False) for x in batch.columns]
        if rest is not None:
            columns = [np.concatenate(x) for x in zip(rest, columns, strict=True)]
        token = columns[0]
        if not len(token):
            continue
        keep = int(np.searchsorted(token, token[-1], side="left"))
        rest = [x[keep:] for x in columns]
        yield [x[:keep] for x in columns]
    if rest is not None:
        yield rest


def _new(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


def _reach(size: np.ndarray, t100: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest size of a set that sets of these sizes can link with."""
    return (t100 * size + 99) // 100, 100 * size // t100


def _block_least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The least of values[lo:hi] for each of these (non-empty) blocks."""
    out, width = np.empty(len(lo), values.dtype), np.frexp((hi - lo).astype(np.float64))[1] - 1
    table = values
    for level in range(int(width.max(initial=0)) + 1):
        now = np.flatnonzero(width == level)
        out[now] = np.minimum(table[lo[now]], table[hi[now] - (1 << level)])
        step = 1 << level
        table = np.concatenate([np.minimum(table[:-step], table[step:]), table[-step:]]) if step < len(table) else table
    return out


def _shared(batches, t100: int):
    """Entries whose list has another that sizes allow to link, each with the least hash among these and itself."""
    for token, fp, place in _lists(batches):
        new = _new(token, place, fp)  # sorted by token, place, fp; copies in other tasks list a set again
        token, fp, place = token[new], fp[new], place[new]
        if not len(token):
            continue
        size = place >> 32
        run = np.cumsum(_new(token)) << 32
        low, high = _reach(size, t100)
        lo, hi = np.searchsorted(run + size, run + low), np.searchsorted(run + size, run + high, side="right")
        keep = np.flatnonzero(hi - lo > 1)
        if len(keep):
            leader = _block_least(fp, lo[keep], hi[keep])
            yield pa.RecordBatch.from_arrays([*(pa.array(x[keep]) for x in (token, fp, place)), pa.array(leader)], ["token", "fp", "place", "leader"])


def _least_shared(n, m, t100: int):
    """No more than the prefix shingles that two linked sets share, if one has size n and the other any size up to m.

    A shingle beyond the shorter prefix is beyond both; so many of the overlap can't be seen.  Between two
    sizes the bound is highest near n, so that of m is the least; 2 are allowed for rounding.
    """
    rest = lambda x: x - prefix_size(x, t100)
    return needed(n, m, t100) - np.maximum(rest(n), rest(m)) - 2


def _met(batches, t100: int):
    """For each set and each hub that it meets (key): lists in which it does, and how many any partner there needs.

    Of two hubs the one with more followers is the host, and the other's sets are its guests.  ``near`` says
    whether in one of the lists enough shingles follow the set's place for a link.
    """
    names = ["key", "fp", "n", "guest", "lists", "need", "near"]
    for token, place, fp, hub, members in _lists(batches):
        if not len(token):
            continue
        size, at = place >> 32, place & 0xFFFFFFFF
        order = np.lexsort((size, hub, token))
        token, size, at, fp, hub, members = (x[order] for x in (token, size, at, fp, hub, members))
        head = _new(token, hub)
        run = np.cumsum(head) - 1  # blocks of one hub in one list
        first = np.flatnonzero(head)
        listed = np.cumsum(_new(token)) - 1
        runs = np.searchsorted(listed[first], np.arange(listed[-1] + 2))  # the first block of each list
        width = (runs[1:] - runs[:-1])[listed]
        search = (run.astype(np.int64) << 32) + size
        low, high = _reach(size, t100)
        ends = np.concatenate([[0], np.cumsum(width)])
        parts, start = [], 0
        while start < len(token):
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + SPAN, side="right")) - 1)
            x = np.repeat(np.arange(start, stop), width[start:stop])
            r = runs[listed[x]] + np.arange(len(x)) - (ends[x] - ends[start])
            lo, hi = np.searchsorted(search, (r << 32) + low[x]), np.searchsorted(search, (r << 32) + high[x], side="right")
            own = r == run[x]
            ok = hi - lo > own
            x, r, lo, hi, own = x[ok], r[ok], lo[ok], hi[ok], own[ok]
            h, m = hub[first[r]], members[first[r]]
            guest = (m > members[x]) | (m == members[x]) & (h > hub[x])
            need = np.minimum(_least_shared(size[x], size[lo], t100), _least_shared(size[x], size[hi - 1], t100))
            near = size[x] - at[x] >= needed(size[x], size[lo], t100)
            key = np.where(guest, h, hub[x])
            order = np.lexsort((key, x))
            key, x, guest, need, near = (v[order] for v in (key, x, guest, need, near))
            edge = np.flatnonzero(_new(key, x)) if len(x) else np.zeros(0, np.int64)
            if len(edge):
                parts.append([key[edge], fp[x[edge]], size[x[edge]], guest[edge], np.minimum.reduceat(need, edge), np.logical_or.reduceat(near, edge)])
            start = stop
        if not parts:
            continue
        key, fp, size, guest, need, near = (np.concatenate(v) for v in zip(*parts, strict=True))
        order = np.lexsort((fp, key))
        key, fp, size, guest, need, near = (v[order] for v in (key, fp, size, guest, need, near))
        edge = np.flatnonzero(_new(key, fp))
        lists = np.diff(np.concatenate([edge, [len(key)]]))
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (key[edge], fp[edge], size[edge], guest[edge], lists, np.minimum.reduceat(need, edge), np.logical_or.reduceat(near, edge))], names)


def _slot(column: str):
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)).cast("bigint")


def _filter(wanted: DataFrame, column: str):
    """A broadcast filter of FILTER_BITS bits, whatever the number of keys: none of ``wanted`` fails it."""
    slot = _slot(column) + 1
    bits = wanted.select(F.bitmap_bucket_number(slot).alias("k"), F.bitmap_bit_position(slot).alias("bit")).groupBy("k").agg(F.bitmap_construct_agg("bit").alias("bits"))
    mask = np.zeros(FILTER_BITS // 8, np.uint8)
    for k, part in bits.collect():  # FILTER_BITS / 32768 rows of 4096 bytes at most
        mask[(k - 1) * 4096 : k * 4096] = np.frombuffer(bytes(part), np.uint8)
    return wanted.sparkSession.sparkContext.broadcast(mask)


def _passes(mask: np.ndarray, slot: pa.Array) -> pa.Array:
    slot = slot.to_numpy()
    return pa.array(mask[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 == 1)


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """fp and tokens (8 bytes each, sorted) of the documents in ``wanted`` (doc_id) and a few others; an fp may come twice."""
    sent = _filter(wanted, "doc_id")

    def run(batches):
        for batch in texts(batches):
            batch = batch.filter(_passes(sent.value, batch.column(2)))
            if not batch.num_rows:
                continue
            flat, bounds = shingle_sets(batch.column(1), width)
            own = [flat[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([_signed(_fingerprints(flat, bounds)), pa.array(own, pa.binary())], ["fp", "tokens"])

    return docs.withColumn("__slot", _slot("doc_id")).mapInArrow(run, "fp bigint, tokens binary")


def _hubs(lists: DataFrame) -> DataFrame:
    """(fp, hub, members): the set that leads a set (it may be itself) in most of its lists, and how many follow that."""
    led = lists.groupBy("fp", "leader").agg(F.count("*").alias("n"))
    hubs = materialize(led.groupBy("fp").agg(F.min_by("leader", F.struct(-F.col("n"), F.col("leader"))).alias("hub")), "hubs")
    return hubs.join(hubs.groupBy("hub").agg(F.count("*").alias("members")), "hub").select("fp", "hub", "members")


def link_sets(fps: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, guest: np.ndarray, t100: int, copies: np.ndarray | None = None) -> tuple[list[tuple[int, int, int]], np.ndarray]:
    """Links (a, b, overlap) between left and right sets that join components, and the copies of each set's partners.

    The overlaps of a set with all others follow from those of the answered set that it differs from least, by
    the lists of the shingles in which they differ, where these are fewer than its own.  Two guests aren't compared.
    """
    copies = np.ones(len(sets), np.int64) if copies is None else copies
    degree, every = np.zeros(len(sets), np.int64), np.arange(len(sets))
    size = np.array([len(x) for x in sets])
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    own = np.split(code, np.cumsum(size)[:-1])
    flat, bounds = np.repeat(every, size)[np.argsort(code, kind="stable")], np.concatenate([[0], np.cumsum(count)])

    def of(tokens: np.ndarray) -> np.ndarray:
        tokens = tokens[count[tokens] > 1]
        n = count[tokens]
        at = np.repeat(bounds[tokens] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.bincount(flat[at], minlength=len(sets))

    bases, answers = np.zeros(0, np.int64), np.zeros((BASES, len(sets)), np.int64)
    component, out = every.copy(), []
    both = left & right
    for answered, x in enumerate(np.flatnonzero(left)):
        other = right & ~(both & (every <= x)) if both[x] else right.copy()
        other[x] = False
        if guest[x]:
            other &= ~guest
        if not other.any():
            continue
        far = size[bases] + size[x] - 2 * answers[: len(bases), x]
        k = int(far.argmin()) if len(far) else -1
        if k >= 0 and far[k] < size[x]:
            base = own[bases[k]]
            gone, more = np.setdiff1d(base, own[x], assume_unique=True), np.setdiff1d(own[x], base, assume_unique=True)
            overlap = answers[k] - of(gone) + of(more)
        else:
            overlap = of(own[x])
        slot = answered % BASES if len(bases) == BASES else len(bases)
        bases = np.append(bases, x) if slot == len(bases) else np.where(np.arange(BASES) == slot, x, bases)
        answers[slot] = overlap
        linked = np.flatnonzero(other & (100 * overlap >= t100 * (size[x] + size - overlap)))
        degree[x] += copies[linked].sum()
        degree[linked] += copies[x]
        for y in linked[component[linked] != component[x]]:
            if component[y] != component[x]:
                out.append((int(fps[x]), int(fps[y]), int(overlap[y])))
                component[component == component[y]] = component[x]
    return out, degree


def _linked(rows: DataFrame, sets: DataFrame, copies: DataFrame, t100: int) -> DataFrame:
    """Links between the sets (fp, n, guest) that meet at each key.

    Rows (a, b, null) are links that join components, rows (a, null, links) the links of a set in one task,
    each as often as its partner has ``copies`` (fp, copies).  More than HELD sets, or BYTES of them, are cut
    into blocks, and each two blocks meet in a task of their own.
    """
    blocks = rows.groupBy("key").agg(F.count("*").alias("sets"), F.count_if(~F.col("guest")).alias("hosts"), (F.sum("n") * 8).alias("bytes")).where("sets > 1 AND hosts > 0")
    blocks = blocks.select("key", F.ceil(F.greatest(F.col("sets") / HELD, F.col("bytes") / BYTES)).cast("int").alias("blocks"))
    rows = rows.join(blocks, "key").join(copies, "fp").withColumn("block", F.pmod(F.xxhash64("fp"), "blocks").cast("int"))
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("key", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"), "block", "fp", "guest", "copies")

    def run(key, table):
        _, i, j = (k.as_py() for k in key)
        table = table.sort_by("fp")
        fps, block, copies = (table.column(k).to_numpy() for k in ("fp", "block", "copies"))
        own = [np.frombuffer(x, np.uint64) for x in table.column("tokens").to_pylist()]
        guest = table.column("guest").to_numpy(zero_copy_only=False).astype(bool)
        found, degree = link_sets(fps, own, block == i, block == j, guest, t100, copies)
        held = np.flatnonzero(degree)
        a = pa.array([x[0] for x in found] + fps[held].tolist(), pa.int64())
        b = pa.array([x[1] for x in found] + [None] * len(held), pa.int64())
        return pa.Table.from_arrays([a, b, pa.array([None] * len(found) + degree[held].tolist(), pa.int64())], ["a", "b", "links"])

    rows = rows.join(sets.dropDuplicates(["fp"]), "fp").select("key", "i", "j", "block", "fp", "guest", "copies", "tokens")
    return rows.groupBy("key", "i", "j").applyInArrow(run, "a bigint, b bigint, links bigint")


def near_duplicates(docs: DataFrame, width: int = 5, similarity: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links for each document, without losing a link.

    Two documents link when the Jaccard similarity of their shingle sets is ``similarity`` percent or
    more; component_id is the least doc_id that links reach, n_links the number of all other rows that a
    row links with, copies of its own set included.
    """
    spark, t100 = docs.sparkSession, similarity
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keys = materialize(_sizes(docs, width), "keys")
    classes = materialize(
        keys.where("n_shingles > 0").groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), (F.min("fp_check") != F.max("fp_check")).alias("torn")),
        "classes",
    )
    common = _common(docs, keys.count(), width, t100)
    index = _postings(docs, common, width, t100).repartition("token").sortWithinPartitions("token", "place", "fp")
    lists = materialize(index.mapInArrow(lambda batches: _shared(batches, t100), "token bigint, fp bigint, place bigint, leader bigint"), "lists")
    release(spark)

    entries = lists.join(_hubs(lists), "fp").select("token", "place", "fp", "hub", "members").repartition("token").sortWithinPartitions("token", "place", "fp")
    met = entries.mapInArrow(lambda batches: _met(batches, t100), "key bigint, fp bigint, n bigint, guest boolean, lists bigint, need bigint, near boolean")
    met = met.groupBy("key", "fp").agg(F.max("n").alias("n"), F.max("guest").alias("guest"), F.sum("lists").alias("lists"), F.min("need").alias("need"), F.max("near").alias("near"))
    rows = materialize(met.where("near AND lists >= need").select("key", "fp", "n", "guest"), "rows")
    discard(lists)
    release(spark)

    wanted = materialize(rows.select("fp").distinct().join(classes, "fp").select(F.col("rep").alias("doc_id")), "wanted")
    links = materialize(_linked(rows, _sets(docs, wanted, width), classes.select("fp", "copies"), t100), "links")
    discard(rows, wanted)
    release(spark)
    joined = connected_components(links.where("b IS NOT NULL").select("a", "b"))
    degree = links.where("b IS NULL").groupBy(F.col("a").alias("fp")).agg(F.sum("links").alias("links"))
    named = classes.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "component").join(degree, "fp", "left").select("fp", "component_id", "copies", F.coalesce("links", F.lit(0)).alias("links"), "torn")
    named = materialize(named, "named")
    discard(classes, links, joined)
    if named.where("torn").limit(1).count():
        raise ValueError("two different sets share a 64-bit hash: change the constants in shingles.py")
    held = keys.where("n_shingles > 0").join(named, "fp").select("doc_id", "n_shingles", "component_id", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    alone = keys.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(0).cast("bigint").alias("n_links"))
    return held.unionByName(alone)
