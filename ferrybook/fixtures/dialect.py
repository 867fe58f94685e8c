"""Relations derived from the given tables, written once as SQL for Spark and the checking engine.

Only the inputs of the checks are shared; what the operators do to them is written twice.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Dialect:
    spark: bool
    folder: str = ""

    def table(self, name: str) -> str:
        return f"parquet.`{self.folder}/{name}.parquet`" if self.spark else name

    @property
    def text(self) -> str:
        return "string" if self.spark else "varchar"

    def s(self, e: str) -> str:
        return f"cast({e} as {self.text})"

    def zero(self, e: str, width: int) -> str:
        return f"lpad({self.s(e)}, {width}, '0')"

    def minutes(self, e: str) -> str:
        if self.spark:
            return f"make_interval(0, 0, 0, 0, 0, cast({e} as int), 0)"
        return f"to_minutes(cast({e} as int))"

    def seconds(self, e: str) -> str:
        if self.spark:
            return f"make_interval(0, 0, 0, 0, 0, 0, cast({e} as int))"
        return f"to_seconds(cast({e} as int))"

    def ymd(self, e: str) -> str:
        return f"date_format({e}, 'yyyyMMdd')" if self.spark else f"strftime({e}, '%Y%m%d')"

    def stamp(self, e: str) -> str:
        return f"date_format({e}, 'yyMMddHHmmss')" if self.spark else f"strftime({e}, '%y%m%d%H%M%S')"

    def ts(self, text: str) -> str:
        return f"timestamp_ntz '{text}'" if self.spark else f"timestamp '{text}'"

    def cents(self, e: str) -> str:
        return f"cast(round({e} * 100) as bigint)"


DUCK = Dialect(spark=False)
