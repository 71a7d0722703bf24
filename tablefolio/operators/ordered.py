"""Ordered computations inside a group that stay parallel when one group is huge.

A plain window puts a whole group into one task. Here a group is cut into fixed segments of its row index.
Running values use one small record per segment: the record is aggregated before the shuffle, the window over
the records gives each segment what came before it, and the rows themselves are only ever grouped by
(group, segment). Neighbours use copies of the few edge rows of each segment instead of a join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT_ROWS = 1 << 16
SEGMENT = _SEG = "__segment"


@dataclass(frozen=True)
class RowOrder:
    """Rows of each `keys` group in `idx` order; `idx` counts from 0 without gaps where neighbours are used.

    `segment_rows=None` says every group is known to fit one task: plain windows, one shuffle for all of them.
    """

    keys: tuple[str, ...]
    idx: str
    segment_rows: int | None = SEGMENT_ROWS

    def _segment(self) -> Column:
        return F.floor(F.col(self.idx) / F.lit(self.segment_rows)).cast("long")

    def running(self, df: DataFrame, sums: dict[str, Column] | None = None, maxima: dict[str, Column] | None = None,
                inclusive: bool = True) -> DataFrame:
        """Add running sums and running maxima over all earlier rows, and the row itself if `inclusive`.

        A maximum over `struct(idx, value)` that is null where there is no value carries the last value forward.
        Rows that kept their segment from `neighbours` are not shuffled again.
        """
        sums, maxima = sums or {}, maxima or {}
        last = Window.currentRow if inclusive else -1
        if self.segment_rows is None:
            w = Window.partitionBy(*self.keys).orderBy(self.idx).rowsBetween(Window.unboundedPreceding, last)
            return df.withColumns({n: F.coalesce(F.sum(c).over(w), F.lit(0)) for n, c in sums.items()}
                                  | {n: F.max(c).over(w) for n, c in maxima.items()})
        by = [*self.keys, _SEG]
        tagged = df if _SEG in df.columns else df.withColumn(_SEG, self._segment())
        records = tagged.groupBy(*by).agg(*[F.sum(c).alias(f"__in_{n}") for n, c in sums.items()],
                                          *[F.max(c).alias(f"__in_{n}") for n, c in maxima.items()])
        before = Window.partitionBy(*self.keys).orderBy(_SEG).rowsBetween(Window.unboundedPreceding, -1)
        carried = records.select(
            *by,
            *[F.sum(f"__in_{n}").over(before).alias(f"__before_{n}") for n in sums],
            *[F.max(f"__in_{n}").over(before).alias(f"__before_{n}") for n in maxima],
        )
        inside = Window.partitionBy(*by).orderBy(self.idx).rowsBetween(Window.unboundedPreceding, last)
        out = tagged.join(carried, by, "left").withColumns(
            {n: F.coalesce(F.col(f"__before_{n}"), F.lit(0)) + F.coalesce(F.sum(c).over(inside), F.lit(0))
             for n, c in sums.items()}
            | {n: F.greatest(F.col(f"__before_{n}"), F.max(c).over(inside)) for n, c in maxima.items()}
        )
        return out.drop(_SEG, *[f"__before_{n}" for n in (*sums, *maxima)])

    def neighbours(self, df: DataFrame, wanted: dict[str, tuple[Column, int]],
                   keep_segment: bool = False) -> DataFrame:
        """Add values of rows at a fixed offset: negative looks back, positive looks ahead, outside -> null.

        `keep_segment` leaves the segment column in place for a `running` that follows.
        """
        if self.segment_rows is None:
            w = Window.partitionBy(*self.keys).orderBy(self.idx)
            return df.withColumns({n: F.lead(c, o).over(w) for n, (c, o) in wanted.items()})
        back = max([0, *[-o for _, o in wanted.values()]])
        ahead = max([0, *[o for _, o in wanted.values()]])
        seg, pos = self._segment(), F.col(self.idx) % F.lit(self.segment_rows)
        homes = [F.struct(seg.alias(_SEG), F.lit(True).alias("__own"))]
        if back:
            homes.append(F.when(pos >= self.segment_rows - back,
                                F.struct((seg + 1).alias(_SEG), F.lit(False).alias("__own"))))
        if ahead:
            homes.append(F.when((pos < ahead) & (seg > 0),
                                F.struct((seg - 1).alias(_SEG), F.lit(False).alias("__own"))))
        spread = df.select("*", F.inline(F.array_compact(F.array(*homes))))
        w = Window.partitionBy(*self.keys, _SEG).orderBy(self.idx)
        out = spread.withColumns({n: F.lead(c, o).over(w) for n, (c, o) in wanted.items()})
        return out.where("__own").drop("__own", *([] if keep_segment else [_SEG]))

    def dense(self, df: DataFrame, name: str) -> DataFrame:
        """Number the rows from 0 without gaps, keeping their order."""
        numbered = self.running(df, sums={"__n": F.lit(1).cast("long")})
        return numbered.withColumn(name, (F.col("__n") - 1).cast("int")).drop("__n")

    def last_rows(self, df: DataFrame, n: int) -> DataFrame:
        """The last `n` rows of each group with their rank from the end (`from_end`, 1 = last).

        Spark keeps at most `n` rows per group and map task before the shuffle, so hot groups stay small.
        """
        w = Window.partitionBy(*self.keys).orderBy(F.col(self.idx).desc())
        return df.withColumn("from_end", F.row_number().over(w)).where(F.col("from_end") <= n)


def settled(df: DataFrame) -> DataFrame:
    """Compute all columns of `df` once, as one record.

    Catalyst otherwise substitutes column definitions into every later filter; with decisions that build on each
    other that grows without bound. A generator over the one record stops the substitution and costs no shuffle.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))
