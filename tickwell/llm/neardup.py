"""Near copies by MinHash bands, odd sketches and an exact check.

Texts with the same words collapse into one class. Each class has a MinHash
signature of 128 values: bands of four propose candidates, and an odd sketch,
a bitmap in which every value of the signature toggles one bit, rules out
most of the false ones: the number of set bits in the XOR of two sketches
estimates their similarity. What remains is confirmed on the full sets.

Buckets of a band may be large. Their members are first compared with two
pivots each; what that links needs no further comparison. Where a bucket still
holds several components, the members outside its largest one are compared
with all of that one's members in the bucket, block against block, and then
with each other. No candidate is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.llm.components import components
from tickwell.llm.tables import by_batch, id_and_text, unused, written

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 32, 4
SKETCH_BITS = 512
#: Texts on each side when blocks of texts are compared.
BLOCK = 256
#: Pairs whose sketches estimate less than this are not confirmed: five standard deviations below 0.75.
LEAST_ESTIMATE = 0.5
SAMPLES = BANDS * ROWS
SKETCH = [f"o{i}" for i in range(SKETCH_BITS // 64)]

_random = np.random.default_rng(20240501)
_FACTORS = _random.integers(1, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_MASKS = _random.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32)
_SALTS = _random.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)
_BAND_SALTS = _random.integers(0, 1 << 63, BANDS, dtype=np.uint64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def normal(text: str) -> list[bytes]:
    """Words, with A-Z in lower case."""
    return text.encode().lower().split()


def shingles(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; all words together if there are fewer than ``size``."""
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh3_64_intdigest(joined)], dtype=np.uint64)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    digest = xxhash.xxh3_64_intdigest
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    return np.unique(np.array([digest(joined[s:e]) for s, e in spans], dtype=np.uint64))


def signature(hashes: np.ndarray) -> np.ndarray:
    """MinHash values of a non-empty set."""
    short = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    out = np.full(SAMPLES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(short), 2048):
        part = (short[None, at : at + 2048] ^ _MASKS[:, None]) * _FACTORS[:, None]
        np.minimum(out, part.min(1), out=out)
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """One key per band of each signature (rows of ``values``); bands have different keys."""
    pairs = np.ascontiguousarray(values).view(np.uint64).reshape(len(values), BANDS, ROWS // 2)
    keys = np.broadcast_to(_BAND_SALTS, (len(values), BANDS)).copy()
    for i in range(ROWS // 2):
        keys = _mixed(keys ^ pairs[:, :, i]) + _MIX
    return keys.view(np.int64)


def odd_sketches(values: np.ndarray) -> np.ndarray:
    """Parity bitmaps of signatures, as 64-bit words."""
    bits = _mixed(values.astype(np.uint64) ^ _SALTS) % np.uint64(SKETCH_BITS)
    flat = bits.astype(np.int64) + np.arange(len(values))[:, None] * SKETCH_BITS
    odd = np.bincount(flat.reshape(-1), minlength=len(values) * SKETCH_BITS) & 1
    packed = np.packbits(odd.astype(np.uint8).reshape(len(values), SKETCH_BITS), axis=1)
    return packed.view("<i8")


def most_different_bits(estimate: float = LEAST_ESTIMATE) -> int:
    """Set bits in the XOR of two sketches at which the estimated similarity falls to ``estimate``."""
    share = 1 - np.exp((estimate - 1) * 4 * SAMPLES / SKETCH_BITS)
    return int(np.ceil(SKETCH_BITS * share / 2))


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, words_hash, bands, o0..`` of every row; empty texts have no bands."""
    schema = "doc_id long, n_shingles long, words_hash binary, bands array<long>, " + ", ".join(
        f"{o} long" for o in SKETCH
    )

    def work(pieces: Iterator[dict]) -> Iterator[dict]:
        for piece in pieces:
            sizes, hashes, values = [], [], []
            for text in piece["text"]:
                words = normal(text)
                found = shingles(words)
                sizes.append(len(found))
                hashes.append(xxhash.xxh3_128_digest(b" ".join(words)))
                values.append(signature(found) if len(found) else np.zeros(SAMPLES, np.uint32))
            stacked = np.stack(values)
            some = np.array(sizes) > 0
            ends = np.concatenate([[0], np.cumsum(some * BANDS)]).astype(np.int32)
            keys = pa.array(band_keys(stacked)[some].reshape(-1))
            odd = odd_sketches(stacked)
            yield {
                "doc_id": piece["doc_id"],
                "n_shingles": sizes,
                "words_hash": hashes,
                "bands": pa.ListArray.from_arrays(pa.array(ends), keys),
            } | {o: odd[:, i] for i, o in enumerate(SKETCH)}

    return by_batch(docs, schema, work)


def _likely(left: str, right: str) -> Column:
    """Whether two classes can be similar enough, by size and by sketch."""
    n, m = F.col(f"{left}.n_shingles"), F.col(f"{right}.n_shingles")
    differ = sum((F.bit_count(F.col(f"{left}.{o}").bitwiseXOR(F.col(f"{right}.{o}"))) for o in SKETCH), F.lit(0))
    return (100 * F.least(n, m) >= PERCENT * F.greatest(n, m)) & (differ <= most_different_bits())


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough."""

    def side(name: str) -> DataFrame:
        return texts.select(F.col("rep").alias(name), F.col("text").alias(f"text_{name}"))

    def work(pieces: Iterator[dict]) -> Iterator[dict]:
        for piece in pieces:
            linked = []
            for one, other in zip(piece["text_a"], piece["text_b"]):
                x, y = shingles(normal(one)), shingles(normal(other))
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            keep = pa.array(linked, type=pa.bool_())
            yield {"a": piece["a"].filter(keep), "b": piece["b"].filter(keep)}

    rows = pairs.join(side("a"), "a").join(side("b"), "b")
    return by_batch(rows.select("a", "b", "text_a", "text_b"), "a long, b long", work)


def _hub_links(mixed: DataFrame, sketches: DataFrame, texts: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between the outsiders of buckets and the component that is largest there.

    Outsiders and members of one component are dealt to blocks of about
    ``BLOCK`` texts, and every block of outsiders meets every block of
    members, so rows move once per block and not once per pair. One link to
    a component is enough.
    """
    sides = {}
    for side, test in (("a", "component <> hub"), ("b", "component = hub")):
        rows = mixed.where(test).select("hub", "rep").distinct()
        count = rows.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(f"n_{side}"))
        sides[side] = (rows, count)
    blocks = sides["a"][1].join(sides["b"][1], "hub")
    dealt = None
    for side, other in (("a", "b"), ("b", "a")):
        rows = sides[side][0].join(blocks, "hub")
        own = F.pmod(F.xxhash64("rep"), F.col(f"n_{side}")).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(f"n_{other}") - 1))
        rows = rows.select("hub", "rep", F.lit(side).alias("side"), own.alias(side), every.alias(other))
        dealt = rows if dealt is None else dealt.unionByName(rows)
    rows = dealt.join(sketches, "rep").join(texts.select("rep", "text"), "rep")

    def compared(table: pa.Table) -> pa.Table:
        side = np.array(table.column("side").to_pylist())
        reps = table.column("rep").to_numpy()
        counts = table.column("n_shingles").to_numpy()
        odd = np.column_stack([table.column(o).to_numpy() for o in SKETCH]).view(np.uint64)
        texts = table.column("text")
        sets: dict[int, np.ndarray] = {}

        def of(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingles(normal(texts[i].as_py()))
            return sets[i]

        inside = np.flatnonzero(side == "b")
        found = []
        for i in np.flatnonzero(side == "a").tolist():
            differ = np.bitwise_count(odd[inside] ^ odd[i]).sum(1)
            n, m = counts[i], counts[inside]
            likely = (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)) & (differ <= limit)
            for j in inside[likely][np.argsort(differ[likely], kind="stable")].tolist():
                both = len(np.intersect1d(of(i), of(j), assume_unique=True))
                if 100 * both >= PERCENT * (len(of(i)) + len(of(j)) - both):
                    found.append((reps[i], reps[j]))
                    break
        columns = list(zip(*found)) or [(), ()]
        return pa.table({n: pa.array(c, type=pa.int64()) for n, c in zip(("a", "b"), columns)})

    limit = most_different_bits()
    columns = rows.withColumnsRenamed({"a": "block_a", "b": "block_b"})
    return columns.groupBy("hub", "block_a", "block_b").applyInArrow(compared, "a long, b long")


def _named(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members with the component they are in so far."""
    known = found.select(F.col("node").alias("rep"), "component")
    return members.join(known, "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    Two documents are linked if their sets of five-word shingles have a
    Jaccard similarity of at least 0.75. ``component_id`` is the smallest id
    that links reach, and the row with that id is kept. Null and empty texts
    have no shingles and no links. Rows of one id count as one document. Rows
    with a null id are linked with nothing: their component is null, and they are kept.
    """
    source = id_and_text(docs, id_col, text_col)
    signed = written(signatures(source))
    linkable = signed.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    # Copies are one class; sums are made before anything is moved.
    grouped = linkable.groupBy("words_hash").agg(
        F.min("doc_id").alias("rep"),
        F.any_value(F.struct("n_shingles", "bands", *SKETCH)).alias("s"),
    )
    classes = written(grouped.select("words_hash", "rep", "s.*"))
    of_band = classes.select("rep", F.explode("bands").alias("bucket"))
    shared = of_band.groupBy("bucket").agg(
        F.min("rep").alias("pivot_0"), F.max("rep").alias("pivot_1"), F.count("*").alias("n")
    )
    shared = shared.where("n > 1 and pivot_0 <> pivot_1").drop("n")
    members = written(of_band.join(shared, "bucket"))
    involved = members.select("rep").distinct()
    texts = written(
        source.withColumnRenamed("doc_id", "rep").join(involved, "rep").dropDuplicates(["rep", "text"])
    )
    sketches = written(
        classes.join(involved, "rep", "left_semi").select("rep", "n_shingles", *SKETCH)
    )

    pivots = F.explode(F.array("pivot_0", "pivot_1"))
    pairs = members.select(F.col("rep").alias("a"), pivots.alias("b")).where("a <> b")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    found = _joined(None, _next_links(pairs, sketches, texts))

    # Buckets that still hold more than one component, with the largest of them.
    named = _named(members.select("bucket", "rep"), found)
    sizes = named.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    hubs = sizes.groupBy("bucket").agg(
        F.max(F.struct("n", "component")).alias("hub"), F.count("*").alias("components")
    )
    hubs = hubs.where("components > 1").select("bucket", F.col("hub.component").alias("hub"), F.col("hub.n").alias("n"))
    mixed = written(named.join(hubs, "bucket"))
    found = _joined(found, _hub_links(mixed.where("n > 1"), sketches, texts))

    # Members outside the largest component, or of buckets in which all stand alone.
    rest = mixed.where("component <> hub or n = 1").select("bucket", "rep")
    lists = rest.groupBy("rep").agg(F.collect_set("bucket").alias("buckets"))
    rows = written(_named(rest, found).join(lists, "rep").join(sketches, "rep"))
    left, right = rows.alias("l"), rows.alias("r")
    across = left.join(
        right,
        (F.col("l.bucket") == F.col("r.bucket"))
        & (F.col("l.rep") < F.col("r.rep"))
        & (F.col("l.component") != F.col("r.component"))
        & _likely("l", "r")
        # A pair that shares several buckets leaves the first of them only.
        & (F.col("l.bucket") == F.array_min(F.array_intersect("l.buckets", "r.buckets"))),
    )
    pairs = across.select(F.col("l.rep").alias("a"), F.col("r.rep").alias("b")).distinct()
    found = _joined(found, _confirmed(pairs, texts))

    named_classes = classes.select("words_hash", "rep").join(
        found.select(F.col("node").alias("rep"), "component"), "rep", "left"
    )
    named_classes = named_classes.select(
        F.col("words_hash").alias("_hash"), F.coalesce("component", "rep").alias("class_component")
    )
    out = signed.select("doc_id", "n_shingles", "words_hash")
    out = out.join(
        named_classes,
        (F.col("words_hash") == F.col("_hash")) & F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0),
        "left",
    )
    component = F.coalesce("class_component", "doc_id")
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each group of near copies, with all its columns.

    The row with the smallest id stays; of several rows with that id, any one.
    Rows without an id or without words have no copies and all stay.
    """
    verdicts = near_duplicates(docs, id_col, text_col)
    named = verdicts.where(F.col("doc_id").isNotNull())
    by_id = named.groupBy("doc_id").agg(F.bool_and("kept").alias("kept"), F.count("*").alias("n"))
    by_id = written(by_id.where("not kept or n > 1"))

    name = unused("_id", docs)

    def ids(rows: DataFrame) -> DataFrame:
        return rows.select(F.col("doc_id").alias(name))

    same = F.col(id_col).cast("long") == F.col(name)
    single = docs.join(ids(by_id), same, "left_anti")
    repeated = docs.join(ids(by_id.where("kept")), same, "left_semi").dropDuplicates([id_col])
    return single.unionByName(repeated)


def _next_links(pairs: DataFrame, sketches: DataFrame, texts: DataFrame) -> DataFrame:
    left, right = sketches.alias("l"), sketches.alias("r")
    likely = (
        pairs.join(left, F.col("a") == F.col("l.rep"))
        .join(right, F.col("b") == F.col("r.rep"))
        .where(_likely("l", "r"))
        .select("a", "b")
        .distinct()
    )
    return _confirmed(likely, texts)


def _joined(found: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components of the links, with those found before as one star each."""
    links = written(links)
    if found is not None:
        if links.isEmpty():
            return found
        stars = found.where("node <> component")
        links = links.unionByName(stars.select(F.col("component").alias("a"), F.col("node").alias("b")))
    return written(components(links))
