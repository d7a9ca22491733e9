"""Best representative of each duplicate group, field by field.

Within a group the rows of the better class come first, then the latest. Rows
without a timestamp are placed by currency: value transitions are learnt from
the timestamped rows of all groups; a value is newer than another if the
strongest chain of learnt transitions leads from the other to it, whatever the
chain's length, which breaks cycles by their counts. That orders the values of
each group in part, and the topologically latest is taken.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemill.functions.text import strip_blanks
from sievemill.session import cut

#: Stand-ins for "not given", in lower case; signs alone are no value either.
STAND_INS = ("n/i", "n/d", "n/a", "n.i.", "n.d.", "n.a.", "não informado", "não informada", "nao informado", "nao informada", "sem informação", "sem informacao", "não consta", "nao consta", "null", "none")
_DAY = 86_400_000_000


def has_value(value: Column) -> Column:
    """False for null, blanks, signs without a letter or digit, and stand-ins."""
    text = F.lower(strip_blanks(value))
    return F.coalesce(text.rlike(r"[\p{L}\p{N}]") & ~text.isin(*STAND_INS), F.lit(False))


def learn_precedence(rows: DataFrame, key: str, fields: list[str], at: str) -> DataFrame:
    """Which value of a field follows which: ``field, older, newer, n``.

    ``rows`` holds null where a field has no value. Counted are the changes
    between consecutive timestamped rows of a group; a pair counts in the
    direction that is more frequent. Groups are walked day by day, and the
    days of a group joined by their first and last values, so a group may
    hold any share of the rows as long as no single day of it does.
    """
    dated = rows.where(F.col(at).isNotNull()).withColumn("__day", F.floor(F.col(at) / F.lit(_DAY)))
    inside = Window.partitionBy(key, "__day").orderBy(at, "__arrival").rowsBetween(Window.unboundedPreceding, -1)
    steps = dated.select(*(F.struct(F.last(f, ignorenulls=True).over(inside).alias("older"), F.col(f).alias("newer")).alias(f) for f in fields))
    order = F.struct(F.col(at), F.col("__arrival"))
    edges = dated.groupBy(key, "__day").agg(
        *(F.min_by(F.col(f), F.when(F.col(f).isNotNull(), order)).alias(f"{f}__a") for f in fields),
        *(F.max_by(F.col(f), F.when(F.col(f).isNotNull(), order)).alias(f"{f}__z") for f in fields),
    )
    across = Window.partitionBy(key).orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    joints = edges.select(*(F.struct(F.last(f"{f}__z", ignorenulls=True).over(across).alias("older"), F.col(f"{f}__a").alias("newer")).alias(f) for f in fields))
    pairs = steps.unionByName(joints).select(F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"{f}.older").alias("older"), F.col(f"{f}.newer").alias("newer")) for f in fields))).alias("p"))
    seen = pairs.select("p.*").where("older <> newer")
    both = seen.groupBy("field", F.least("older", "newer").alias("a"), F.greatest("older", "newer").alias("b")).agg(
        F.count_if(F.col("older") < F.col("newer")).alias("up"), F.count_if(F.col("older") > F.col("newer")).alias("down")
    )
    return both.where("up <> down").select(
        "field", F.when(F.col("up") > F.col("down"), F.col("a")).otherwise(F.col("b")).alias("older"),
        F.when(F.col("up") > F.col("down"), F.col("b")).otherwise(F.col("a")).alias("newer"), F.abs(F.col("up") - F.col("down")).alias("n"),
    )


def currency(precedence: DataFrame, among: DataFrame) -> DataFrame:
    """The partial order of values: ``field, older, newer``.

    The strength of a chain of learnt transitions is that of its weakest
    transition; ``newer`` is newer than ``older`` if the strongest chain from
    older to newer is stronger than any chain back. That relation has no
    cycles and is transitive. Chains run through the values of ``among``
    (``field, value``) and are found by doubling: each round joins the chains
    known so far, so their number of steps doubles until nothing changes.
    """
    ends = among.select("field", "value").distinct()
    chains = precedence.join(ends.withColumnRenamed("value", "older"), ["field", "older"], "left_semi")
    chains = cut(chains.join(ends.withColumnRenamed("value", "newer"), ["field", "newer"], "left_semi").select("field", "older", "newer", "n"))
    size = None
    while True:
        now = chains.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).first()
        if now == size:
            break
        size = now
        onward = chains.select("field", F.col("older").alias("newer"), F.col("newer").alias("__to"), F.col("n").alias("__n"))
        longer = chains.join(onward, ["field", "newer"]).where("older <> __to").select("field", "older", F.col("__to").alias("newer"), F.least("n", "__n").alias("n"))
        chains = cut(chains.unionByName(longer).groupBy("field", "older", "newer").agg(F.max("n").alias("n")))
    back = chains.select("field", F.col("newer").alias("older"), F.col("older").alias("newer"), F.col("n").alias("__back"))
    return chains.join(back, ["field", "older", "newer"], "left").where("__back is null or n > __back").select("field", "older", "newer")


def best_fields(
    df: DataFrame, key: Column, fields: list[str], preferred: Column, at: Column, arrival: Column,
    valid: Callable[[Column], Column] = has_value, least_rows: int = 2,
) -> DataFrame:
    """For each group and field the row that supplies it: ``key, field, value, arrival``.

    A group is the rows of one ``key`` (null keys belong to no group) and
    needs ``least_rows`` rows. A field comes from the rows where it is valid:
    ``preferred`` rows first, then the latest ``at`` (microseconds), then the
    lowest ``arrival``. A value without a timestamp in the same class takes
    the place of the latest dated one if :func:`currency` has it as newer, or
    if there is no dated one; of several such values one that no other of
    them is newer than is taken, then the lowest arrival. Fields without a
    valid value don't come out. Repeated rows make a group but change no
    choice. The order is only learnt if some group has such values; groups
    without them are settled by one aggregate.
    """
    rows = df.select(
        key.alias("__key"), F.coalesce(preferred, F.lit(False)).cast("int").alias("__pref"), at.alias("__at"), arrival.alias("__arrival"),
        *(F.when(valid(F.col(f)), F.col(f)).alias(f) for f in fields),
    ).where("__key is not null")
    rank = F.struct("__pref", "__at", (-F.col("__arrival")).alias("__neg"))

    def best(f: str, dated: bool) -> Column:
        here = F.col(f).isNotNull() & (F.col("__at").isNotNull() if dated else F.col("__at").isNull())
        return F.max(F.when(here, F.struct(rank.alias("rank"), F.col(f).alias("value"))))

    wide = rows.groupBy("__key").agg(
        F.count(F.lit(1)).alias("__n"), *(best(f, True).alias(f"{f}__d") for f in fields), *(best(f, False).alias(f"{f}__u") for f in fields)
    ).where(F.col("__n") >= least_rows)
    long = wide.select("__key", F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"{f}__d").alias("d"), F.col(f"{f}__u").alias("u")) for f in fields))).alias("c"))
    long = cut(long.select("__key", "c.field", "c.d", "c.u").where("d is not null or u is not null"))
    dated_first = F.col("d").isNotNull() & (F.col("u").isNull() | (F.col("d.rank.__pref") > F.col("u.rank.__pref")))
    settled = long.where(dated_first).select(F.col("__key").alias("key"), "field", F.col("d.value").alias("value"), (-F.col("d.rank.__neg")).alias("arrival"))
    open_groups = long.where(~dated_first).select(
        "__key", "field", F.col("u.rank.__pref").alias("__pref"), F.when(F.col("d.rank.__pref") == F.col("u.rank.__pref"), F.col("d")).alias("d")
    )
    if open_groups.isEmpty():
        return settled
    undated = rows.where("__at is null").select("__key", "__pref", "__arrival", F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields))).alias("c"))
    undated = undated.select("__key", "__pref", "__arrival", "c.field", "c.value").where("value is not null")
    undated = undated.groupBy("__key", "__pref", "field", "value").agg(F.min("__arrival").alias("__arrival"))
    candidates = cut(undated.join(open_groups, ["__key", "field", "__pref"]).select("__key", "field", "value", "__arrival", F.col("d.value").alias("__dated")))
    among = candidates.select("field", "value").unionByName(candidates.where("__dated is not null").select("field", F.col("__dated").alias("value")))
    order = cut(currency(learn_precedence(rows, "__key", fields, "__at"), among))
    beats = order.select("field", F.col("older").alias("__dated"), F.col("newer").alias("value"), F.lit(True).alias("__beats"))
    rivals = candidates.join(beats, ["field", "__dated", "value"], "left").where("__dated is null or __beats").select("__key", "field", "value", "__arrival")
    later = rivals.join(order.select("field", F.col("older").alias("value"), F.col("newer").alias("__next")), ["field", "value"]).select("__key", "field", "value", "__next")
    surpassed = later.join(rivals.select("__key", "field", F.col("value").alias("__next")), ["__key", "field", "__next"], "left_semi").select("__key", "field", "value").distinct()
    latest = rivals.join(surpassed, ["__key", "field", "value"], "left_anti").groupBy("__key", "field").agg(F.min_by(F.struct("value", "__arrival"), "__arrival").alias("w"))
    chosen = open_groups.join(latest, ["__key", "field"], "left").select(
        F.col("__key").alias("key"), "field", F.coalesce(F.col("w.value"), F.col("d.value")).alias("value"),
        F.when(F.col("w").isNotNull(), F.col("w.__arrival")).otherwise(-F.col("d.rank.__neg")).alias("arrival"),
    )
    return settled.unionByName(chosen)
