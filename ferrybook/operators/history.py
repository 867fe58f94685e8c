"""History files: overpunch amounts, newest replacement ids, amounts split to the field width."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrybook.functions.text import AMOUNT_LIMIT, overpunch_decode, overpunch_encode
from ferrybook.operators.layout import encode
from ferrybook.session import broadcast_if_small


def decoded(history: DataFrame) -> DataFrame:
    """Adds the signed amount and the last seven characters of the amount text."""
    return history.withColumn("int_amount", overpunch_decode(F.col("adj_amt"))).withColumn(
        "adj_amount_revised", F.right("adj_amt", F.lit(7))
    )


def latest_crosswalk(crosswalk: DataFrame, keys: Sequence[str], term: str, tie: str) -> DataFrame:
    """The newest row per key. Spark keeps one row per key and task before it shuffles."""
    newest = Window.partitionBy(*keys).orderBy(F.col(term).desc(), F.col(tie).desc())
    return (
        crosswalk.withColumn("_place", F.row_number().over(newest)).where(F.col("_place") == 1).drop("_place")
    )


def with_new_ids(history: DataFrame, crosswalk: DataFrame, keys: Sequence[str], term: str, tie: str) -> DataFrame:
    """History rows with the ids of the newest crosswalk row, NULL where there is none."""
    newest = latest_crosswalk(crosswalk, keys, term, tie).drop(term, tie)
    return history.join(broadcast_if_small(newest), list(keys), "left")


def split_count(amount: Column) -> Column:
    """Rows an amount needs; amounts within the limit need one."""
    return F.greatest(F.lit(1), F.ceil(F.abs(amount) / F.lit(AMOUNT_LIMIT)).cast("int"))


def split_amounts(rows: DataFrame, amount: str = "int_amount") -> DataFrame:
    """One row per part: full parts of the limit, the last part the remainder, all of one sign."""
    total = F.abs(F.col(amount))
    left = total - (F.col("part") - 1) * F.lit(AMOUNT_LIMIT)
    return (
        rows.withColumn("part", F.explode(F.sequence(F.lit(1), split_count(F.col(amount)))))
        .withColumn("part_amount", F.signum(amount).cast("bigint") * F.least(left, F.lit(AMOUNT_LIMIT)))
    )


def too_large(amount: Column) -> Column:
    return ~amount.between(-AMOUNT_LIMIT, AMOUNT_LIMIT)


def detail_lines(rows: DataFrame) -> DataFrame:
    """Fixed-width history lines of small and large amounts alike, large ones split."""
    split = split_amounts(rows)
    line = encode(
        [
            (F.lit("4"), 1), (F.col("member_id"), 18), (F.col("new_carrier"), 9), (F.col("new_account"), 15),
            (F.col("new_group"), 15), (F.lit("A"), 1),
            # a small amount keeps its text, so a negative zero stays one
            (F.when(too_large(F.col("int_amount")), overpunch_encode(F.col("part_amount"))).otherwise(F.col("adj_amount_revised")), 7),
            (F.col("accum_code"), 10), (F.col("adjusted"), 7), (F.lit(""), 10), (F.lit(""), 207),
        ]
    )
    return split.select("line_number", "part", line.alias("value"))


def trailer_line(lines: DataFrame, carrier: str) -> DataFrame:
    """Type 9, the carrier id of the header and the zero-filled number of detail lines."""
    count = lines.agg(F.lpad(F.count(F.lit(1)).cast("string"), 9, "0").alias("n"))
    return count.select(encode([(F.lit("9"), 1), (F.lit(carrier), 9), (F.col("n"), 9), (F.lit(""), 281)]).alias("value"))
