"""Filling fixed-capacity containers with texts.

Mixture-controlled packing: each container is filled from queues, one per
source, by deficit round-robin, so that the tokens of every stretch of
containers keep the target proportions of the sources. Deficits are carried
from container to container, and from one partition to the next: what the
partitions before have put in of each source is known from their token
totals, as each partition packs all its texts.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemill.functions.text import BLANKS
from sievemill.operators.checks import running_totals
from sievemill.session import cut

#: Tokens per partition: a group of this size is packed by one task.
PARTITION_TOKENS = 2_000_000


def count_tokens(docs: DataFrame, text: str, vocabulary: str) -> DataFrame:
    """The documents with ``n_tokens`` of a public tokenizer.

    ``vocabulary`` is the path of a ``.tiktoken`` ranks file, a ``.json`` file
    of the tokenizers library or a ``.model`` file of sentencepiece. Special
    tokens in a text are ordinary text. Null texts have null tokens.
    """

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        size = _counter(vocabulary)
        for batch in batches:
            yield pd.Series([None if t is None else size(t) for t in batch], dtype="Int64")

    return docs.withColumn("n_tokens", count(text))


def _counter(vocabulary: str):
    if vocabulary.endswith(".tiktoken"):
        import base64

        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(vocabulary, "rb"))}
        encoding = tiktoken.Encoding("own", pat_str=_SPLITS, mergeable_ranks=ranks, special_tokens={})
        return lambda t: len(encoding.encode_ordinary(t))
    if vocabulary.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(vocabulary)
        tokenizer.encode_special_tokens = True
        return lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    return lambda t: len(processor.encode(t))


#: The split pattern of the byte-level vocabularies. A fixed value.
_SPLITS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def fill(sizes: list[int], sources: list[str], capacity: int, shares: dict[str, float], carried: dict[str, float]) -> list[int]:
    """The container of each item, numbered from 0. Items are no larger than ``capacity``.

    Deficit round-robin: opening a container grants each source its share of
    the capacity. The source with the largest deficit gives its largest item
    that fits, and its deficit falls by the item's size; sources without an
    item that fits are passed over, and a container closes when none has one.
    Items of a source are kept sorted, so the best fit is found by bisection.
    """
    queues: dict[str, list[tuple[int, int]]] = {}
    for i, (n, s) in enumerate(zip(sizes, sources, strict=True)):
        queues.setdefault(s, []).append((n, i))
    for q in queues.values():
        q.sort()
    deficits = {s: carried.get(s, 0.0) for s in queues}
    out = [0] * len(sizes)
    container, left = 0, len(sizes)
    while left:
        for s in deficits:
            deficits[s] += shares.get(s, 0.0) * capacity
        room = capacity
        while room and left:
            best = None
            for s, q in queues.items():
                if q and q[0][0] <= room and (best is None or deficits[s] > deficits[best]):
                    best = s
            if best is None:
                break
            q = queues[best]
            n, i = q.pop(bisect.bisect_right(q, (room, len(sizes))) - 1)
            out[i] = container
            room -= n
            deficits[best] -= n
            left -= 1
        container += 1
    return out


def pack(
    docs: DataFrame, doc_id: str, text: str, source: str, vocabulary: str, capacity: int = 2048,
    shares: dict[str, float] | None = None, partition_tokens: int = PARTITION_TOKENS,
) -> DataFrame:
    """The container of each text or piece.

    Columns: ``doc_id, piece, first_token, n_tokens, source, container``.
    Null and blank texts are left out. A text beyond ``capacity`` is cut into
    full pieces and a rest; only the rest shares a container. Null sources
    make a source of their own. ``shares`` are the target proportions of
    tokens, by default those of all texts. Repeated rows are packed each; a
    text without tokens takes no room.

    Texts are spread over partitions of about ``partition_tokens``, each with
    its part of every source, in the order of a hash of the row, so no group
    grows with the data; a container number is the partition's first number
    plus its own.
    """
    base = docs.where(F.col(text).rlike(f"[^{BLANKS}]")).select(
        F.col(doc_id).alias("doc"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.col(text).alias("text")
    )
    sized = cut(count_tokens(base, "text", vocabulary).select("doc", "source", "n_tokens", F.xxhash64("doc", "source", "text").alias("h")))
    pieces = sized.select(
        "doc", "source", "h", "n_tokens",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("n_tokens") / capacity) - 1, F.lit(0).cast("bigint")))).alias("piece"),
    ).select("doc", "source", "h", "piece", (F.col("piece") * capacity).alias("first_token"), F.least(F.col("n_tokens") - F.col("piece") * capacity, F.lit(capacity)).alias("n"))
    total = sized.agg(F.sum("n_tokens").alias("t")).first()["t"] or 0
    parts = max(1, -(-total // partition_tokens))
    # Each source's pieces in the order of their hash are cut into as many slices of equal tokens as there are partitions, so every
    # partition has the sources in the proportions of the whole.
    laid = cut(running_totals(pieces, ["source", "h", "piece"], {"so_far": F.col("n")}))
    sources = laid.groupBy("source").agg(F.min("so_far").alias("start"), F.sum("n").alias("of_source"))
    slot = F.floor((F.col("so_far") - F.col("start")) / F.greatest("of_source", F.lit(1)) * F.lit(parts))
    pieces = laid.join(sources, "source").withColumn("part", F.least(slot, F.lit(parts - 1)).cast("bigint")).drop("so_far", "start", "of_source")
    totals = pieces.groupBy("part", "source").agg(F.sum("n").alias("tokens"))
    whole = totals.groupBy("source").agg(F.sum("tokens").alias("all"))
    if shares is None:
        target = whole.select("source", (F.col("all") / F.lit(max(total, 1))).alias("share"))
    else:
        pairs = F.create_map(*(F.lit(x) for kv in shares.items() for x in kv)) if shares else F.lit(None).cast("map<string,double>")
        target = whole.select("source", F.coalesce(F.try_element_at(pairs, F.col("source")), F.lit(0.0)).alias("share"))
    # What each partition takes over: the target share of all tokens before it less the tokens of the source before it.
    totals = cut(totals)
    ahead = running_totals(totals.groupBy("part").agg(F.sum("tokens").alias("part_tokens")), ["part"], {"tokens_before": F.col("part_tokens")}).select("part", "tokens_before")
    # Summed over (source, part) in order; what a source had before its first part is its least sum.
    laid = cut(running_totals(totals, ["source", "part"], {"so_far": F.col("tokens")}))
    begun = laid.groupBy("source").agg(F.min("so_far").alias("start"))
    carried = laid.join(begun, "source").withColumn("own_before", F.col("so_far") - F.col("start")).join(ahead, "part").join(target, "source")
    carried = carried.groupBy(F.col("part").alias("of_part")).agg(
        F.map_from_entries(F.collect_list(F.struct("source", (F.col("share") * F.col("tokens_before") - F.col("own_before")).alias("v")))).alias("carried"),
        F.map_from_entries(F.collect_list(F.struct("source", F.col("share").cast("double").alias("v")))).alias("shares"),
    )
    schema = T.StructType([
        T.StructField("doc", sized.schema["doc"].dataType), T.StructField("piece", T.LongType()), T.StructField("first_token", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("source", T.StringType()), T.StructField("part", T.LongType()), T.StructField("own", T.LongType()),
    ])

    def pack_part(key: tuple, items: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["n", "h", "piece"], kind="mergesort")
        where = fill(items["n"].tolist(), items["source"].tolist(), capacity, dict(state["shares"].iloc[0]), dict(state["carried"].iloc[0]))
        return pd.DataFrame({
            "doc": items["doc"], "piece": items["piece"], "first_token": items["first_token"], "n_tokens": items["n"],
            "source": items["source"], "part": key[0], "own": where,
        })

    packed = cut(pieces.groupBy("part").cogroup(carried.groupBy("of_part")).applyInPandas(pack_part, schema))
    sized_parts = packed.groupBy("part").agg((F.max("own") + 1).alias("k"))
    first = running_totals(sized_parts, ["part"], {"first": F.col("k")}).select("part", "first")
    numbered = packed.join(first, "part")
    return numbered.select(F.col("doc").alias(doc_id), "piece", "first_token", "n_tokens", "source", (F.col("first") + F.col("own")).alias("container"))


def mixture(packed: DataFrame, stretch: int = 100) -> DataFrame:
    """How each stretch of consecutive containers is mixed: ``stretch, source, share, target``.

    ``share`` is the source's part of the stretch's tokens, ``target`` its
    part of all tokens. Only whole stretches are reported, as the last one
    holds what is left over; a source without a token in a stretch doesn't
    come out for it.
    """
    last = packed.agg(F.max("container").alias("m")).first()["m"]
    per = cut(packed.groupBy(F.floor(F.col("container") / stretch).alias("stretch"), "source").agg(F.sum("n_tokens").alias("n")))
    whole = per.groupBy("stretch").agg(F.sum("n").alias("all"))
    overall = per.groupBy("source").agg(F.sum("n").alias("of_source"))
    total = per.agg(F.sum("n").alias("t")).first()["t"]
    joined = per.join(whole, "stretch").join(overall, "source")
    kept = joined.where((F.col("stretch") + 1) * stretch <= F.lit(0 if last is None else last + 1))
    return kept.select("stretch", "source", (F.col("n") / F.col("all")).alias("share"), (F.col("of_source") / F.lit(total)).alias("target"))
