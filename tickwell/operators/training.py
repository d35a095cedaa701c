"""Fixed-length token sequences and shuffled batches."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.fixed_values import BATCH_SIZE, SEQUENCE_LENGTH
from tickwell.functions.text import first_words, words
from tickwell.operators.dealt import numbered
from tickwell.session import keep, stored

PAD, UNKNOWN, FIRST_ID = 0, 1, 2
#: A vocabulary that may be sent to every task, in bytes of words and their numbers.
SENT_BYTES = 16 << 20
#: Ranges of ids in which a larger vocabulary is measured.
SHARES = 1024
PADDED = "struct<input_ids:array<int>,attention_mask:array<int>>"


def vocabulary(df: DataFrame, text: str = "text", parts: int | None = None) -> DataFrame:
    """Words of all texts with their counts and ids, frequent words first."""
    counts = (
        df.select(F.explode(words(F.lower(F.col(text)))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("rarity", -F.col("n"))
    )
    # One row per word: far smaller than the texts, which are read only once.
    placed, _ = numbered(keep(counts), ["rarity", "token"], "place", parts)
    return placed.select("token", "n", (F.col("place") + FIRST_ID).cast("int").alias("token_id"))


def token_sequences(
    df: DataFrame,
    vocab: DataFrame,
    id: str = "id",
    text: str = "text",
    length: int = SEQUENCE_LENGTH,
) -> DataFrame:
    """(id, input_ids, attention_mask, labels) of exactly ``length`` each.

    Longer texts are cut, shorter ones padded; labels repeat the ids, pads
    included. Words outside the vocabulary get the id for unknown ones.

    The vocabulary is written and measured. The words of the lowest ids, which
    are the frequent ones, are sent to the texts up to ``SENT_BYTES`` and are
    looked up array by array where the texts are. Only occurrences of the
    words that are left, few of each, move to be joined.
    """
    first = first_words(F.lower(F.col(text)), length)
    words = stored(vocab.select("token", "token_id"))
    end = _sent_below(words)
    if end is None:
        ids = _looked_up(words.toArrow(), length)(first)
    else:
        sent, rest = words.where(F.col("token_id") < end), words.where(F.col("token_id") >= end)
        looked = df.select(id, _numbers_and_others(sent.toArrow())(first).alias("_found"))
        df = _with_others(looked, rest, id)
        ids = _filled(length)("_numbers", "_joined")
    found = df.select(id, ids.alias("_ids"))
    return found.select(id, "_ids.input_ids", "_ids.attention_mask", F.col("_ids.input_ids").alias("labels"))


def _sent_below(words: DataFrame) -> int | None:
    """The id from which words are not sent any more; None if all may be."""
    size = F.coalesce(F.sum(F.octet_length("token") + 8), F.lit(0))
    total, last = words.agg(size, F.max("token_id")).first()
    if total <= SENT_BYTES:
        return None
    # At most SHARES rows, however large the vocabulary is.
    width = -(-(last + 1) // SHARES)
    share = F.floor(F.col("token_id") / width).alias("share")
    sizes = {r[0]: r[1] for r in words.groupBy(share).agg(size).collect() if r[0] is not None}
    end, sent = min(sizes), 0
    for share in sorted(sizes):
        sent += sizes[share]
        if sent > SENT_BYTES:
            break
        end = share + 1
    return end * width


def _padded(numbers, counts, length: int) -> pa.Array:
    """Lists of numbers, one after the other, as padded lists and masks."""
    import numpy as np
    import pyarrow as pa

    used = np.arange(length)[None, :] < counts[:, None]
    ids = np.full(used.shape, PAD, dtype=np.int32)
    ids[used] = numbers
    ends = pa.array(np.arange(0, used.size + 1, length, dtype=np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(x.ravel())) for x in (ids, used.astype(np.int32))]
    return pa.StructArray.from_arrays(lists, names=["input_ids", "attention_mask"])


def _looked_up(words: pa.Table, length: int):
    """A function of word arrays; ``words`` are few enough for a task."""
    found = _lookup(words)

    @F.arrow_udf(PADDED)
    def numbered_words(texts: pa.Array) -> pa.Array:
        numbers, counts, _ = found(texts)
        return _padded(numbers, counts, length)

    return numbered_words


def _lookup(words: pa.Table):
    """A function from word arrays to the numbers of all words, one after the
    other, how many each array has, and which words have no number."""
    tokens, numbers = words.column("token").combine_chunks(), words.column("token_id").to_numpy()

    def found(texts: pa.Array):
        import numpy as np
        import pyarrow.compute as pc

        counts = pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False)
        at = pc.fill_null(pc.index_in(texts.flatten(), value_set=tokens), -1).to_numpy(zero_copy_only=False)
        missing = at < 0
        return np.where(missing, UNKNOWN, numbers[at]) if len(numbers) else np.full(len(at), UNKNOWN), counts, missing

    return found


def _numbers_and_others(words: pa.Table):
    """A function of word arrays: the numbers of the words, and the words that have none."""
    found = _lookup(words)

    @F.arrow_udf("struct<numbers:array<int>,others:array<struct<pos:int,token:string>>>")
    def split_words(texts: pa.Array) -> pa.Array:
        import numpy as np
        import pyarrow as pa

        numbers, counts, missing = found(texts)
        ends = np.concatenate([[0], np.cumsum(counts)])
        others = np.flatnonzero(missing)
        row = np.searchsorted(ends, others, side="right") - 1
        pos = pa.array((others - ends[row]).astype(np.int32))
        tokens = texts.flatten().take(pa.array(others)).cast(pa.string())
        rest = pa.StructArray.from_arrays([pos, tokens], names=["pos", "token"])
        return pa.StructArray.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(numbers.astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(np.searchsorted(others, ends).astype(np.int32)), rest),
            ],
            names=["numbers", "others"],
        )

    return split_words


def _with_others(looked: DataFrame, rest: DataFrame, id: str) -> DataFrame:
    """(id, _numbers, _joined): the numbers found, and place and number of the
    words that were joined. Rows are told apart by a number of their own, so
    ids may repeat."""
    row = F.monotonically_increasing_id().alias("_row")
    rows = stored(looked.select(row, id, F.col("_found.numbers").alias("_numbers"), F.col("_found.others").alias("_others")))
    others = rows.select("_row", F.inline("_others")).join(rest, "token")
    # Never more entries than a sequence has.
    joined = others.groupBy("_row").agg(F.collect_list(F.struct("pos", "token_id")).alias("_joined"))
    return rows.drop("_others").join(joined, "_row", "left")


def _filled(length: int):
    """A function of numbers and of place and number of the words joined to them."""

    @F.arrow_udf(PADDED)
    def filled(numbers: pa.Array, joined: pa.Array) -> pa.Array:
        import numpy as np
        import pyarrow.compute as pc

        counts = pc.list_value_length(numbers).to_numpy(zero_copy_only=False)
        values = np.array(numbers.flatten())
        starts = np.cumsum(counts) - counts
        more = pc.fill_null(pc.list_value_length(joined), 0).to_numpy(zero_copy_only=False)
        entries = joined.flatten()
        at = np.repeat(starts, more) + entries.field("pos").to_numpy(zero_copy_only=False)
        values[at] = entries.field("token_id").to_numpy(zero_copy_only=False)
        return _padded(values, counts, length)

    return filled


def shuffled_batches(
    df: DataFrame,
    epochs: int,
    id: str = "id",
    seed: int = 0,
    size: int = BATCH_SIZE,
    parts: int | None = None,
) -> DataFrame:
    """(epoch, batch, slot, id): all rows in a new order every epoch, cut into
    batches. The order follows from ids, epoch and seed alone."""
    key = F.md5(F.concat_ws("|", F.col(id).cast("string"), F.col("epoch").cast("string"), F.lit(str(seed))))
    rows = df.select(id, F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    rows = rows.withColumn("draw", key)
    placed, total = numbered(rows, ["epoch", "draw", id], "place", parts)
    # Every epoch has all rows.
    place = F.col("place") - F.col("epoch") * F.lit(total // epochs)
    return placed.select(
        "epoch",
        F.floor(place / size).alias("batch"),
        F.pmod(place, F.lit(size)).alias("slot"),
        id,
    )
