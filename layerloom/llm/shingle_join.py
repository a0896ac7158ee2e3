"""Jaccard join on word n-grams by token-combination prefixes.

The tokens of a document are its distinct word n-grams (shingles), as 64-bit hashes. All documents
agree on an order of tokens: rare ones first, frequent ones by ascending document frequency. Two
documents that differ in few tokens must agree on some of the first ones. Rare tokens of the prefix
are signatures by themselves. Frequent tokens are dealt into small classes, and pairs of tokens of
one class are signatures; as a class may then hold one common token without a common pair, the
prefix is extended until the tokens that count outnumber those in which a partner may differ.

Documents with a common signature are candidates. Candidates pass an exact bound first: where every
token flips one bit, two bitmaps differ in no more bits than the sets differ in tokens. Those left
are verified on the whole token sets. Lists of few documents give all their pairs. A longer list
gives the pairs with its smallest document; documents of long lists that verified links have not
brought together are then compared in blocks, by bitmaps within the tasks, so every link between
different components is found while no list is expanded into pairs.

Documents with equal sets are one node from the start. Frequencies are exact counts over all
documents; the ``FREQUENT`` most frequent tokens form the broadcast table with their counts. Those
beyond them are frequent as well, or else their lists would chain unrelated documents into one
cluster: they are told from rare ones by a map of bytes, which holds their levels of frequency. Its
size is bounded. A rare token may hit a byte of another and then counts as frequent, in all
documents alike, which changes work and not results.

Defined cases: null and empty texts have no token and link with nothing; a document with fewer words
than a shingle has its whole word sequence as one token; equal rows are one node; a null id is
returned with a null component; rows with one id and different texts count as one document; an empty
table gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.llm.byte_bpe import slices
from layerloom.llm.common import bit_map, in_bit_map, shuffle_partitions, stage
from layerloom.llm.components import components

# Defaults of ``words`` and ``percent``, those of op6's contract. Two documents link when
# 100 * intersection >= percent * union.
WORDS = 4
PERCENT = 85
# A token of more documents is frequent; lists up to this length give all pairs.
RARE = 10
FREQUENT = 1 << 19
# The map of the frequent tokens beyond: 2^LEVEL_BITS bytes at most, in slices of 2^SLICE_BITS.
LEVEL_BITS = 25
SLICE_BITS = 16
# Bytes for each token in it, while there are few.
SPARSE = 8
# The map of documents to verify: 2^18 longs, 2 MB. A fuller one lets more texts move.
MAP_BITS = 18
# Documents in a block of a long list's cluster.
BLOCK = 256
# Smallest size for which frequent tokens are paired.
PAIRED = 20
# Tokens of a prefix in one class of frequent tokens, about.
CLASS = 4
_K = np.uint64(0x9E3779B97F4A7C15)
NO_LEVELS = np.zeros(0, np.uint8)


def _mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _parts(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """Ids and token sets, a few megabytes of text at a time."""
    for batch in batches:
        at = 0
        for part in slices(batch.column("text")):
            yield batch.column("doc_id").slice(at, len(part)), shingles(part, words)
            at += len(part)


def shingles(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text. A-Z is lower-cased; words are separated by
    ASCII white space."""
    out = []
    for part in slices(texts):
        lower = pc.ascii_lower(pc.fill_null(part, ""))
        for c in "\t\n\v\f\r":
            lower = pc.replace_substring(lower, c, " ")
        lists = pc.split_pattern(lower, " ")
        coded = lists.flatten().dictionary_encode()
        names = coded.dictionary.to_pylist()
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, len(names))
        real = np.fromiter(map(bool, names), bool, len(names))
        place = coded.indices.to_numpy()
        doc = np.repeat(np.arange(len(part)), np.diff(lists.offsets.to_numpy()))
        doc, word = doc[real[place]], hashes[place[real[place]]]
        n = max(0, len(word) - words + 1)
        token = np.zeros(n, np.uint64)
        for k in range(words):
            token = token * _K + word[k : k + n]
        inside = doc[:n] == doc[words - 1 :] if n else np.zeros(0, bool)
        token, owner = _mix(token[inside]), doc[:n][inside]
        cut = np.searchsorted(owner, np.arange(len(part) + 1))
        ends = np.searchsorted(doc, np.arange(len(part) + 1))
        for k in range(len(part)):
            mine = np.unique(token[cut[k] : cut[k + 1]])
            if not len(mine) and ends[k + 1] > ends[k]:
                short = word[ends[k] : ends[k + 1]]
                value = np.array([len(short)], np.uint64)
                for w in short:
                    value = value * _K + w
                mine = _mix(value)
            out.append(mine)
    return out


def _bits(n: int) -> int:
    return max(64, 1 << (2 * n - 1).bit_length())


def bitmap(tokens: np.ndarray) -> bytes:
    """One bit per token flipped, in about twice as many bits as tokens (a power of two)."""
    size = _bits(len(tokens))
    flips = np.bincount((tokens & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(flips.astype(bool)).tobytes()


def _fold(bits: bytes, size: int) -> int:
    while len(bits) > size:
        half = len(bits) // 2
        bits = (int.from_bytes(bits[:half]) ^ int.from_bytes(bits[half:])).to_bytes(half)
    return int.from_bytes(bits)


def least_common(total: int, percent: int = PERCENT) -> int:
    """Common tokens that two sets with ``total`` tokens together need at least."""
    return -(-percent * total // (100 + percent))


def may_link(n_a: int, bits_a: bytes, n_b: int, bits_b: bytes, percent: int = PERCENT) -> bool:
    """False only if the sets cannot link: sizes too far apart, or too many bits differ."""
    if 100 * min(n_a, n_b) < percent * max(n_a, n_b):
        return False
    size = min(len(bits_a), len(bits_b))
    differ = (_fold(bits_a, size) ^ _fold(bits_b, size)).bit_count()
    return differ <= n_a + n_b - 2 * least_common(n_a + n_b, percent)


def measure(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id``, ``n`` tokens, a ``digest`` of the set (null if empty) and its ``bits``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _parts(batches, words):
            yield pa.record_batch(
                [
                    ids,
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([bitmap(s) if len(s) else None for s in sets], pa.binary()),
                ],
                names=["doc_id", "n", "digest", "bits"],
            )

    return docs.mapInArrow(run, "doc_id long, n long, digest binary, bits binary")


def frequent_tokens(docs: DataFrame, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
    """The most frequent tokens, as fingerprints in order, with their numbers of documents.

    Tokens are counted within a part of a task, then by ranges of their values; what moves is 4
    bytes per token. Returns also the shift from token to fingerprint, and the map of the levels of
    all other frequent tokens, by the first bits of the token; it is empty if there are none.
    """
    power = max(6, (8 * shuffle_partitions(docs.sparkSession) - 1).bit_length())
    shift = np.uint64(32 - power)
    rest = (1 << 32) - 1

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, every in _parts(batches, words):
            found, n = np.unique(np.concatenate(every) >> shift, return_counts=True)
            edges = np.searchsorted(found, np.arange((1 << power) + 1, dtype=np.uint64) << np.uint64(32))
            low, single = (found & np.uint64(rest)).astype("<u4"), n == 1
            held = np.flatnonzero(np.diff(edges))
            rows = [(low[a:b], single[a:b], n[a:b]) for a, b in zip(edges[held], edges[held + 1])]
            columns = [
                pa.array(held.astype(np.int32)),
                pa.array([t[s].tobytes() for t, s, _ in rows], pa.binary()),
                pa.array([t[~s].tobytes() for t, s, _ in rows], pa.binary()),
                pa.array([c[~s].astype("<u4").tobytes() for _, s, c in rows], pa.binary()),
            ]
            yield pa.record_batch(columns, names=["bucket", "once", "more", "counts"])

    def count(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        join = lambda name: np.frombuffer(b"".join(table[name].to_pylist()), "<u4")
        once, more, counts = join("once"), join("more"), join("counts")
        token, at = np.unique(np.concatenate([once, more]), return_inverse=True)
        n = np.bincount(at, np.concatenate([np.ones(len(once)), counts]), len(token)).astype(np.int64)
        keep = n > RARE
        mark = (bucket << 32) + token[keep].astype(np.int64)
        return pa.table({"mark": pa.array(mark), "n": pa.array(n[keep])})

    parts = docs.mapInArrow(split, "bucket int, once binary, more binary, counts binary")
    counted = parts.groupBy("bucket").applyInArrow(count, "mark long, n long")
    # Levels of frequency, a few hundred at most; the highest ones that fit are taken.
    counted = stage(counted.withColumn("level", F.floor(F.log2("n") * 16).cast("int")))
    sizes = {r["level"]: r["count"] for r in counted.groupBy("level").count().collect()}
    lowest, held = max(sizes, default=0) + 1, 0
    for level in sorted(sizes, reverse=True):
        held += sizes[level]
        if held > FREQUENT:
            break
        lowest = level
    top = counted.where(F.col("level") >= lowest).toPandas().sort_values("mark")
    beyond = sum(n for level, n in sizes.items() if level < lowest)
    levels = _level_map(counted.where(F.col("level") < lowest), beyond, 64 - int(shift))
    return top["mark"].to_numpy(np.uint64), top["n"].to_numpy(np.int64), int(shift), levels


def _level_map(counted: DataFrame, size: int, mark_bits: int) -> np.ndarray:
    """Levels of ``size`` tokens by the first bits of their ``mark``; 0: no token. Where several meet,
    the highest level holds. Slices are filled inside tasks; the driver only puts them together."""
    if not size:
        return np.zeros(0, np.uint8)
    bits = min(LEVEL_BITS, (SPARSE * size - 1).bit_length())
    slice_bits = min(SLICE_BITS, bits)

    def fill(table: pa.Table) -> pa.Table:
        held = np.zeros(1 << slice_bits, np.uint8)
        at = (table["mark"].to_numpy() >> (mark_bits - bits)) & ((1 << slice_bits) - 1)
        np.maximum.at(held, at, np.minimum(table["level"].to_numpy(), 255).astype(np.uint8))
        return pa.table({"slice": table["slice"][:1], "held": pa.array([held.tobytes()], pa.binary())})

    sliced = counted.select("mark", "level", F.shiftright("mark", mark_bits - bits + slice_bits).cast("int").alias("slice"))
    levels = np.zeros((1 << (bits - slice_bits), 1 << slice_bits), np.uint8)
    for r in sliced.groupBy("slice").applyInArrow(fill, "slice int, held binary").toLocalIterator():
        levels[r["slice"]] = np.frombuffer(r["held"], np.uint8)
    return levels.reshape(-1)


def _band(n: int, percent: int) -> int:
    """Partners' bands differ by one at most: a band spans the largest ratio of sizes."""
    return int(np.floor(np.log(n) / np.log(100 / percent) + 1e-9))


def _classes(band: int, percent: int) -> int:
    """Classes of frequent tokens for a band; 0: the sets are too small to pair tokens."""
    size = (100 / percent) ** band
    return 0 if size < PAIRED else max(1, int((1 - percent / 100) * size / CLASS))


def signatures(
    tokens: np.ndarray,
    marks: np.ndarray,
    counts: np.ndarray,
    shift: int,
    percent: int = PERCENT,
    levels: np.ndarray = NO_LEVELS,
) -> np.ndarray:
    """Signatures of one set (sorted tokens). ``levels``: of frequent tokens that are not in ``marks``;
    they come before those in it."""
    n = len(tokens)
    need = n - -(-percent * n // 100) + 1
    mark = tokens >> np.uint64(shift)
    at = np.minimum(np.searchsorted(marks, mark), max(0, len(marks) - 1))
    common = marks[at] == mark if len(marks) else np.zeros(n, bool)
    # Places in the order of frequent tokens; 0: rare. Counts come after all levels.
    place = np.zeros(n, np.int64)
    if len(levels):
        place += levels[tokens >> np.uint64(65 - len(levels).bit_length())]
    place[common] = counts[at[common]] + 256
    common = place > 0
    rare = tokens[~common]
    if len(rare) >= need:
        return rare[:need]
    frequent = tokens[common][np.lexsort((tokens[common], place[common]))]
    need -= len(rare)
    out = [rare]
    for band in (_band(n, percent), _band(n, percent) + 1):
        classes = _classes(band, percent)
        if not classes:
            out.append(frequent[:need])
            continue
        label = (_mix(frequent + np.uint64(band)) % np.uint64(classes)).astype(np.int64)
        order = np.argsort(label, kind="stable")
        # A token counts if its class has one before it.
        seen = np.zeros(len(frequent), bool)
        seen[order] = np.append(False, label[order][1:] == label[order][:-1])
        reach = int(np.searchsorted(np.cumsum(seen), need)) + 1
        prefix, label = frequent[:reach], label[:reach]
        for c in np.unique(label):
            mine = np.sort(prefix[label == c])
            a, b = np.triu_indices(len(mine), 1)
            out.append(_mix(_mix(mine[a]) * _K + mine[b] + np.uint64(band)))
    return np.unique(np.concatenate(out))


def _signed(docs: DataFrame, table, words: int, percent: int) -> DataFrame:
    """``doc_id`` and its ``sigs``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, counts, shift, levels = table.value
        for ids, sets in _parts(batches, words):
            sigs = [(signatures(s, marks, counts, shift, percent, levels) if len(s) else s).view(np.int64) for s in sets]
            yield pa.record_batch([ids, pa.array(sigs, pa.list_(pa.int64()))], names=["doc_id", "sigs"])

    return docs.mapInArrow(run, "doc_id long, sigs array<long>")


def _lists(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs of all lists, and the edges (smallest, member) of the long ones."""
    rows = signed.select(F.explode("sigs").alias("sig"), F.col("doc_id").alias("node"))
    sizes = rows.groupBy("sig").agg(F.count("*").alias("n"), F.min("node").alias("a"), F.max("node").alias("b"))
    shared = stage(sizes.where("n > 1"))
    two = shared.where("n = 2").select("a", "b")
    met = rows.join(shared.where("n > 2").select("sig", "n", F.col("a").alias("least")), "sig")
    met = stage(met)
    long = met.where(F.col("n") > RARE).select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    long = stage(long.where("a != b"))
    # At most RARE rows each.
    short = met.where(F.col("n") <= RARE).groupBy("sig").agg(F.sort_array(F.collect_set("node")).alias("nodes"))
    nodes = F.col("nodes")
    each = F.transform(nodes, lambda a, k: F.transform(F.slice(nodes, k + 2, F.lit(RARE)), lambda b: F.struct(a.alias("a"), b.alias("b"))))
    pairs = short.select(F.explode(F.flatten(each)).alias("p")).select("p.a", "p.b")
    return two.unionAll(pairs).unionAll(long).where("a != b").distinct(), long


def _both(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """Pairs with the columns of ``facts`` (by ``node``) for either side."""
    names = [c for c in facts.columns if c != "node"]
    side = lambda s: facts.select(F.col("node").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in names))
    return pairs.join(side("a"), "a").join(side("b"), "b")


def _screen(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs that the bitmaps do not rule out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("n_a", "bits_a", "n_b", "bits_b")]
            keep = pa.array([may_link(*x, percent) for x in zip(*columns)], pa.bool_())
            yield batch.select(["a", "b"]).filter(keep)

    return _both(pairs, nodes.select("node", "n", "bits")).mapInArrow(run, "a long, b long")


def _verify(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs whose token sets link. Only documents in ``pairs`` are read into sets again, and only
    texts that hit a map of their ids move."""

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, found in _parts(batches, words):
            yield pa.record_batch([ids, pa.array([s.tobytes() for s in found], pa.binary())], names=["node", "tokens"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("tokens_a"), batch.column("tokens_b")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common >= least_common(len(x) + len(y), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    asked = stage(pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select("b")).distinct())
    hashed = F.xxhash64("doc_id")
    hit = in_bit_map(bit_map(asked.select(hashed), MAP_BITS), hashed, MAP_BITS)
    met = docs.where(hit).join(asked, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    found = stage(met.mapInArrow(sets, "node long, tokens binary"))
    return _both(pairs, found).mapInArrow(run, "a long, b long").distinct()


def _blocks(long: DataFrame, nodes: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Pairs of documents of one cluster of long lists, in different components so far, that may
    link. The documents outside a cluster's largest component meet all its documents, those inside
    meet only the others. Both are cut into blocks by hash, and blocks met pairwise."""
    cluster = components(long).select("node", F.col("component").alias("cluster"))
    known = parts.select("node", "component")
    placed = stage(cluster.join(known, "node", "left").withColumn("component", F.coalesce("component", "node")))
    sizes = placed.groupBy("cluster", "component").agg(F.count("*").alias("m"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    shape = sizes.groupBy("cluster").agg(
        F.max_by("component", F.struct("m", "component")).alias("largest"),
        blocks(F.sum("m") - F.max("m")).alias("apart"),
        blocks(F.max("m")).alias("inside"),
    )
    mine = placed.join(shape.where("apart > 0"), "cluster")
    inner = F.col("component") == F.col("largest")
    hashed = F.xxhash64("node")
    block = F.when(inner, F.col("apart") + F.pmod(hashed, F.col("inside"))).otherwise(F.pmod(hashed, F.col("apart")))
    mine = mine.withColumn("block", block.cast("int")).withColumn(
        "meets", F.when(inner, F.col("apart")).otherwise(F.col("apart") + F.col("inside"))
    )
    mine = stage(mine.join(nodes.select("node", "n", "bits"), "node"))
    # Each block goes to every block pair it belongs to.
    other = F.explode(F.sequence(F.lit(0), F.col("meets") - 1)).alias("other")
    sent = mine.select("cluster", "block", "component", "node", "n", "bits", other).select(
        "*", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )

    def meet(table: pa.Table) -> pa.Table:
        column = {c: table[c].to_pylist() for c in ("block", "component", "node", "n", "bits")}
        n = np.array(column["n"])
        part, node, block = (np.array(column[c]) for c in ("component", "node", "block"))
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        left = np.flatnonzero(block == i)
        right = np.flatnonzero(block == j)
        out_a, out_b = [], []
        for x in left.tolist():
            far = right if i != j else right[node[right] > node[x]]
            far = far[(part[far] != part[x]) & (100 * np.minimum(n[far], n[x]) >= percent * np.maximum(n[far], n[x]))]
            for y in far.tolist():
                if may_link(n[x].item(), column["bits"][x], n[y].item(), column["bits"][y], percent):
                    out_a.append(min(node[x], node[y]))
                    out_b.append(max(node[x], node[y]))
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return sent.groupBy("cluster", "i", "j").applyInArrow(meet, "a long, b long").distinct()


def join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, the smallest id reachable by links between
    documents of which at least ``percent`` of 100 shingles of ``words`` words are common."""
    spark = docs.sparkSession
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    measured = stage(measure(picked, words))
    real = measured.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    first = stage(real.groupBy("digest").agg(F.min("doc_id").alias("node")))
    copies = stage(real.select("doc_id", "digest").join(first, "digest").select("doc_id", "node", "digest"))
    own = copies.where("doc_id = node").select("node", "digest").distinct()
    nodes = stage(real.join(own.select(F.col("node").alias("doc_id"), "digest"), ["doc_id", "digest"]).select(
        F.col("doc_id").alias("node"), "n", "bits").distinct())
    table = spark.sparkContext.broadcast(frequent_tokens(picked, words))
    ids = nodes.select(F.col("node").alias("doc_id")).distinct()
    signed = stage(_signed(picked, table, words, percent).join(ids, "doc_id", "left_semi").distinct())
    pairs, long = _lists(signed)
    links = stage(_verify(stage(_screen(pairs, nodes, percent)), picked, words, percent))
    parts = stage(components(links))
    if not long.isEmpty():
        more = stage(_blocks(long, nodes, parts, percent))
        if not more.isEmpty():
            links = links.unionAll(_verify(more, picked, words, percent))
            parts = stage(components(links))
    grouped = copies.join(parts.withColumnRenamed("component", "found"), "node", "left").select(
        "doc_id", "digest", F.coalesce("found", "node").alias("component_id")
    ).distinct()
    same = (measured["doc_id"] == grouped["doc_id"]) & (measured["digest"] == grouped["digest"])
    return measured.join(grouped, same, "left").select(
        measured["doc_id"],
        measured["n"].alias("n_shingles"),
        F.coalesce(grouped["component_id"], measured["doc_id"]).alias("component_id"),
    )
