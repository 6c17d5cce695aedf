"""N-gram Jaccard join by set relations.

A document's set is its distinct word shingles, hashed to 64 bits. Sets link when
their Jaccard similarity is at least ``threshold`` percent. The join is exact up to
hash collisions (a few for each 10^10 sets):

* equal sets are one node from the start;
* shingles are ordered by how often their hash bucket (of two million) occurs in the whole
  corpus, rarest first, finely enough to put passages that documents share last. Linked sets share a shingle in the prefix of that order, so each
  set is listed under the shingles of its prefix, by size and then position;
* within a list, a pair is a candidate only if its sizes and the positions of the
  shingle leave room for the overlap needed, and if the parities of the two sets
  allow it: each set keeps 256 bits, one for the parity of the members in each of 256
  classes, and two sets differ in at least as many members as in bits;
* a candidate is compared by the prefixes first: beyond the shingles that both prefixes
  hold, the sets can only share what follows the prefix of one of them;
* lists are read in blocks of partners at a growing distance. One list in sixteen has a
  head start with neighbours alone, since near copies share many shingles and need not meet at each
  of them; then all lists are read. Pairs whose answer follows from the answers of sets similar to them, since all are in one component
  by now, are skipped. That goes on until no list holds a pair of two components that
  was not considered;
* a long list is read in chunks of consecutive places by as many tasks. A chunk also gets those entries
  before it that its own are paired with, at most half a chunk of them.

So a group of near copies costs a few comparisons per set instead of one per pair.

Defined cases: a null text, or one without words, has an empty set and is linked with
nothing; a text with fewer words than a shingle has its whole word sequence as its
one shingle; rows with a null id are linked with nothing and have a null component;
repeated rows are equal sets; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from marea.llm.common import column, documents
from marea.llm.components import components
from marea.session import materialized

SKETCH_BITS = 21        # buckets of the corpus-wide shingle counts: a fixed 8 MB
PARITY_BITS = 256
FIRST_BLOCK, BLOCK_GROWTH = 8, 8
HEAD_START = 16         # one list in so many is read before all of them are
CACHED_WORDS = 200_000
FAN_IN = 16
MAX_BROADCAST = 500_000
CHUNK = 256             # entries of a list that are read as one, or twice the distance where that is more

_SHIFT = np.uint64(64 - SKETCH_BITS)


class WordHashes(dict):
    """Hash of a word, remembered while it is common enough to matter."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def shingles(text: str | None, words: int, hashes: WordHashes) -> np.ndarray:
    """The set of a text: its distinct shingle hashes, ascending."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    width = min(words, len(found))
    joined = np.full(len(each) - width + 1, width, np.uint64)
    for n in range(width):
        joined = mixed(joined + each[n:len(each) - width + 1 + n])
    return np.unique(joined)


def set_key(members: np.ndarray) -> int:
    """Signed 64-bit name of a set."""
    return int(np.uint64(xxhash.xxh64_intdigest(members.tobytes())).astype(np.int64))


def parities(sets: list[np.ndarray]) -> list[bytes]:
    return [np.packbits(np.bincount((s & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1)
            .tobytes() for s in sets]


def describe_sets(words: int):
    """Task function: id and text to id, set size, set key and parities, and one last row
    with the task's counts of shingle buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = WordHashes(), np.zeros(1 << SKETCH_BITS, np.uint32)
        kind, names = None, ["doc_id", "n_shingles", "set_key", "parity", "counts"]
        for batch in batches:
            kind = batch.schema.field(0).type
            for rows in (batch.slice(n, 2000) for n in range(0, batch.num_rows, 2000)):
                sets = [shingles(t, words, hashes) for t in rows.column(1).to_pylist()]
                found, times = np.unique(np.concatenate(sets) >> _SHIFT, return_counts=True)
                counts[found] += times.astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()),
                     pa.array(parities(sets), pa.binary()), pa.nulls(len(sets), pa.binary())], names=names)
        if kind is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                 pa.array([packed(counts)], pa.binary())], names=names)

    return run


def packed(counts: np.ndarray) -> bytes:
    """Counts as compressed bytes, the bytes of equal weight side by side."""
    return pa.compress(np.ascontiguousarray(counts.view(np.uint8).reshape(-1, 4).T), "zstd", asbytes=True)


def unpacked(data: pa.Buffer | bytes) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 << SKETCH_BITS, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).reshape(-1)


def add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for counts in batch.column(0):
            own = unpacked(counts.as_buffer())
            total = own if total is None else total + np.minimum(own, ~total)
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([packed(total)], pa.binary())], names=["counts"])


def frequency_ranks(described: DataFrame) -> np.ndarray:
    """For each shingle bucket a rank from 0 to 255 that grows with its count: by quantiles for
    the bulk of the buckets, whose counts differ by chance, and by the logarithm above. The
    counts of the tasks are added in a tree; one table of fixed size results."""
    counts = described.where(F.col("counts").isNotNull()).select("counts")
    tasks = counts.count()
    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        counts = counts.repartition(tasks).mapInArrow(add_counts, "counts binary")
    total = [r["counts"] for r in counts.collect()]
    if not total:
        return np.zeros(1 << SKETCH_BITS, np.uint8)
    counts = unpacked(bytes(total[0])).astype(np.float64)
    marks = np.quantile(counts, np.append(np.arange(1, 128) / 128, 0.995))
    bulk = np.searchsorted(marks[:-1], counts, "left")
    above = 128 + np.minimum(127, 12 * np.log2(np.maximum(counts, 1) / max(marks[-1], 1)))
    return np.where(counts > marks[-1], above, bulk).astype(np.uint8)


def prefix_size(size: int, threshold: int) -> int:
    return size + (-threshold * size) // 100 + 1


def prefixes(words: int, threshold: int, ranks: np.ndarray):
    """Task function: texts to (set_key, size, prefix) with the prefix in order, once for
    each set of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, done = WordHashes(), set()
        for batch in batches:
            for rows in (batch.slice(n, 2000) for n in range(0, batch.num_rows, 2000)):
                tokens, keys, sizes = [], [], []
                for text in rows.column(0).to_pylist():
                    members = shingles(text, words, hashes)
                    key = set_key(members)
                    if not len(members) or key in done:
                        continue
                    done.add(key)
                    order = np.argsort(ranks[members >> _SHIFT], kind="stable")
                    tokens.append(members[order[:prefix_size(len(members), threshold)]])
                    keys.append(key)
                    sizes.append(len(members))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()), as_lists(tokens)],
                    names=["set_key", "size", "prefix"])

    return run


def as_lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(ends, pa.array(flat))


def shared_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function over sorted entries: one of each set in a list, without lists of one
    set. The first entry of a list waits until another set comes or the list ends, over
    any number of batches."""
    waiting, token, key = None, None, None      # the last entry's token and set; its list's only set so far
    for batch in batches:
        if not batch.num_rows:
            continue
        tokens, keys = (batch.column(n).to_numpy() for n in ("token", "set_key"))
        same_list = np.concatenate(([token == tokens[0]], tokens[1:] == tokens[:-1]))
        repeat = same_list & np.concatenate(([key == keys[0]], keys[1:] == keys[:-1]))
        token, key = int(tokens[-1]), int(keys[-1])
        now = pa.Table.from_batches([batch]).filter(pa.array(~repeat))
        if waiting is not None:
            now, same_list = pa.concat_tables([waiting, now]), np.concatenate(([False], same_list[~repeat]))
        else:
            same_list = same_list[~repeat]
        if not len(now):
            continue
        follows = np.concatenate((same_list[1:], [False]))
        alone = not same_list[-1]       # the last list has one set until now
        shares = same_list | follows
        yield from now.filter(pa.array(shares)).to_batches()
        waiting = now.slice(len(now) - 1) if alone else None


def placed_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: ``shared_entries`` with the place of each in its list, from 0."""
    token, place = None, 0      # of the last entry
    for batch in shared_entries(batches):
        if not batch.num_rows:
            continue
        tokens, index = batch.column("token").to_numpy(), np.arange(batch.num_rows)
        begins = np.concatenate(([token != tokens[0]], tokens[1:] != tokens[:-1]))
        places = index - np.maximum.accumulate(np.where(begins, index, -1 - place))
        token, place = int(tokens[-1]), int(places[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places)], names=[*batch.schema.names, "place"])


def chunk_size(last: int) -> int:
    return max(CHUNK, 2 * (last + 1))


def chunked(entries: DataFrame, last: int) -> DataFrame:
    """Each entry in the ``chunk`` of its list that its place is in, and again in the next one
    if that holds places up to one more than ``last`` after its own."""
    own, reached = (F.expr(f"(place + {n}) div {chunk_size(last)}") for n in (0, last + 1))
    return entries.withColumn("chunk", F.explode(F.sequence(own, reached)))


def candidate_pairs(threshold: int, first: int, last: int):
    """Task function over the ``chunked`` entries sorted by token, chunk and place: candidates
    (a, b) at distances ``first`` to ``last`` in a list, in different components; and, with a
    null ``a``, the token of each list that goes on beyond."""
    size_of_chunk = chunk_size(last)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            new = [batch.column(n).to_numpy().astype(np.int64) for n in
                   ("token", "set_key", "size", "position", "component", "chunk", "place")]
            bits = np.frombuffer(b"".join(batch.column("parity").to_pylist()), np.uint64)
            new.append(bits.reshape(batch.num_rows, PARITY_BITS // 64))
            begin = 0 if kept is None else len(kept[0])
            token, key, size, position, component, chunk, place, parity = rows = new if kept is None else \
                [np.concatenate(both) for both in zip(kept, new)]
            part = np.cumsum((np.diff(token, prepend=token[:1]) != 0) | (np.diff(chunk, prepend=chunk[:1]) != 0))
            own = place // size_of_chunk == chunk
            lower, upper = [], []
            places = np.arange(max(first, begin), len(token))
            places = places[own[places]]
            for distance in range(first, last + 1):
                places = places[places >= distance]     # those of the last distance whose list goes on
                places = places[part[places] == part[places - distance]]
                if not len(places):
                    break
                y, x = (v[component[places - distance] != component[places]] for v in (places, places - distance))
                fits = 100 * size[x] >= threshold * size[y]
                overlap = np.minimum(size[x] - position[x], size[y] - position[y])
                fits &= (100 + threshold) * overlap >= threshold * (size[x] + size[y])
                x, y = x[fits], y[fits]
                differ = np.bitwise_count(parity[x] ^ parity[y]).sum(1).astype(np.int64)
                fits = (100 + threshold) * differ <= (100 - threshold) * (size[x] + size[y])
                lower.append(np.minimum(key[x[fits]], key[y[fits]]))
                upper.append(np.maximum(key[x[fits]], key[y[fits]]))
            y = np.arange(max(last + 1, begin), len(token))
            x = y - last - 1
            beyond = np.unique(token[y[own[y] & (part[x] == part[y]) & (100 * size[x] >= threshold * size[y])]])
            pairs = np.unique(np.stack((np.concatenate(lower), np.concatenate(upper)), 1), axis=0) if lower \
                else np.zeros((0, 2), np.int64)
            a = pa.array(np.concatenate((pairs[:, 0], beyond)), mask=np.arange(len(pairs) + len(beyond)) >= len(pairs))
            yield pa.RecordBatch.from_arrays([a, pa.array(np.concatenate((pairs[:, 1], beyond)))], names=["a", "b"])
            kept = [column_[-(last + 1):] for column_ in rows]

    return run


def wanted_sets(words: int):
    """Task function: texts to their set key and members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for rows in (batch.slice(n, 2000) for n in range(0, batch.num_rows, 2000)):
                sets = [s for s in (shingles(t, words, hashes) for t in rows.column(0).to_pylist()) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_key(s) for s in sets], pa.int64()), as_lists(sets)], names=["set_key", "members"])

    return run


def hinted(df: DataFrame, rows: int) -> DataFrame:
    """A written table of small rows, to be broadcast if their number allows."""
    return F.broadcast(df) if rows <= MAX_BROADCAST else df


def compared(pairs: DataFrame, heads: DataFrame, holders: DataFrame, texts: DataFrame, words: int,
             threshold: int) -> DataFrame:
    """Written table of those pairs (a, b) whose whole sets are similar enough."""
    count = pairs.count()
    keys = pairs.select(F.explode(F.array("a", "b")).alias("set_key"))
    involved = materialized(heads.join(hinted(keys, 2 * count), "set_key", "left_semi").dropDuplicates(["set_key"]))
    one = involved.select(F.col("set_key").alias("a"), F.col("size").alias("n_a"), F.col("prefix").alias("of_a"))
    other = involved.select(F.col("set_key").alias("b"), F.col("size").alias("n_b"), F.col("prefix").alias("of_b"))
    both = one.join(hinted(pairs, count), "a").join(other, "b")
    after = F.greatest(F.col("n_a") - F.size("of_a"), F.col("n_b") - F.size("of_b"))
    most = F.size(F.array_intersect("of_a", "of_b")) + after
    likely = materialized(both.where((100 + threshold) * most >= threshold * (F.col("n_a") + F.col("n_b"))).select("a", "b"))
    count = likely.count()
    keys = likely.select(F.explode(F.array("a", "b")).alias("set_key")).distinct()
    wanted = materialized(holders.join(hinted(keys, 2 * count), "set_key").select("set_key", "holder"))
    sets = texts.join(hinted(wanted.select("holder").distinct(), 2 * count), F.col("doc_id") == F.col("holder"), "left_semi") \
        .select("text").mapInArrow(wanted_sets(words), "set_key long, members array<bigint>")
    sets = materialized(sets)
    one = sets.select(F.col("set_key").alias("a"), F.col("members").alias("of_a"))
    other = sets.select(F.col("set_key").alias("b"), F.col("members").alias("of_b"))
    both = one.join(hinted(likely, count), "a").join(other, "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    return materialized(both.where(100 * common >= threshold * union).select("a", "b"))


def smallest_documents(holders: DataFrame, groups: DataFrame) -> DataFrame:
    """Written table (set_key, smallest) of the sets that are linked or held more than once, with
    the smallest document of their component. Rows are looked up in it by their set, so that those
    of a large component are not brought together."""
    linked = hinted(groups, groups.count())
    smallest = materialized(holders.join(linked, F.col("set_key") == F.col("node"))
                            .groupBy("component").agg(F.min("holder").alias("smallest")))
    of_linked = groups.join(hinted(smallest, smallest.count()), "component") \
        .select(F.col("node").alias("set_key"), "smallest")
    of_copies = holders.where("held > 1").join(linked, F.col("set_key") == F.col("node"), "left_anti") \
        .select("set_key", F.col("holder").alias("smallest"))
    return materialized(of_linked.unionByName(of_copies))


def join(docs: DataFrame, words: int = 3, threshold: int = 90, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, set_key, component_id`` for every row of ``docs``."""
    texts = docs.select(column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).alias("text"))
    described = materialized(texts.mapInArrow(
        describe_sets(words), "doc_id long, n_shingles long, set_key long, parity binary, counts binary"))
    rows = described.where(F.col("counts").isNull()).select("doc_id", "n_shingles", "set_key")
    holders = materialized(described.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
                           .groupBy("set_key").agg(F.min("doc_id").alias("holder"), F.count("*").alias("held"),
                                                   F.any_value("parity").alias("parity")))
    heads = materialized(texts.where(F.col("doc_id").isNotNull()).select("text").mapInArrow(
        prefixes(words, threshold, frequency_ranks(described)), "set_key long, size int, prefix array<bigint>"))
    entries = heads.select("set_key", "size", F.posexplode("prefix").alias("position", "token")) \
        .select("token", "set_key", "size", "position")
    order = ["token", "size", "position", "set_key"]
    placed = T.StructType([*entries.schema, T.StructField("place", T.LongType())])
    shared = entries.repartition("token").sortWithinPartitions(*order).mapInArrow(placed_entries, placed)
    lists = materialized(shared.join(holders.select("set_key", "parity"), "set_key").select(*placed.names, "parity"))
    head_start = F.pmod("token", F.lit(HEAD_START)) == 0
    active = lists.where(head_start).withColumn("component", F.col("set_key"))
    groups, whole = None, False
    first, last = 1, 1
    while True:
        found = materialized(chunked(active, last).repartition("token", "chunk")
                             .sortWithinPartitions("token", "chunk", "place")
                             .mapInArrow(candidate_pairs(threshold, first, last), "a long, b long"))
        pairs = materialized(found.where(F.col("a").isNotNull()).distinct())
        links = compared(pairs, heads, holders, texts, words, threshold)
        if groups is not None:      # one link per set stands for all found before
            links = links.unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b")))
        groups = materialized(components(links))
        if whole:
            beyond = materialized(found.where(F.col("a").isNull()).select(F.col("b").alias("token")).distinct())
            open_lists = beyond.count()
            if not open_lists:
                break
            active, first = lists.join(hinted(beyond, open_lists), "token", "left_semi"), last + 1
            last *= BLOCK_GROWTH
        else:
            active, whole, last = lists, True, FIRST_BLOCK
        active = active \
            .join(hinted(groups, groups.count()), F.col("set_key") == F.col("node"), "left") \
            .withColumn("component", F.coalesce("component", "set_key")).drop("node")
    smallest = smallest_documents(holders, groups)
    return rows.join(hinted(smallest, smallest.count()), "set_key", "left").select(
        "doc_id", "n_shingles", "set_key",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("smallest", "doc_id")).alias("component_id"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


# All pairs that share a shingle, counted in full.
OP10_SQL = r"""
with recursive texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as w from documents),
sets as (
  select doc_id, unnest(case when len(w) >= 3
    then list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as shingle from texts),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
common as (
  select a.doc_id as x, b.doc_id as y, count(*) as c from sets a join sets b
    on a.shingle = b.shingle and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
near as (
  select x, y from common join sizes p on x = p.doc_id join sizes q on y = q.doc_id
  where 100 * c >= 90 * (p.n + q.n - c)),
links as (select x, y from near union all select y, x from near),
reach as (
  select doc_id as start, doc_id as here from documents
  union select start, y from reach join links on here = x)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, min(here) as component_id
from documents d join reach on d.doc_id = start left join sizes s on s.doc_id = d.doc_id
group by d.doc_id, n
"""
