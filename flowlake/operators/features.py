"""From raw contract columns to the model matrix, the same for training and scoring."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from flowlake import contract
from flowlake.functions.scalar import indicator_reply, indicator_tcp, log_volume, quoted, ratio

# Names and formulas (``engineered_columns``) must equal the published features.
ENGINEERED = (
    "bytes_per_packet", "src_dst_pkt_ratio", "src_dst_byte_ratio",
    "log_rate", "log_totbytes", "log_totpkts",
)
MAX_LEVELS = 5_000


def add_indicators(df: DataFrame) -> DataFrame:
    """Flags from raw values; they must come before nulls are filled."""
    proto = indicator_tcp(F.col("Proto")) if "Proto" in df.columns else F.lit(0)
    reply = indicator_reply(F.col("dTtl")) if "dTtl" in df.columns else F.lit(0)
    return df.withColumns({"is_tcp": proto, "has_dst_reply": reply})


def fill_sentinel(df: DataFrame) -> DataFrame:
    """Numeric nulls mean "does not apply" and become -1; categories stay null."""
    names = [name for name in contract.NUMERIC if name in df.columns]
    return df.na.fill(contract.NULL_SENTINEL, names)


def engineered_columns() -> dict[str, Column]:
    """Directionality ratios and log volumes, from sentinel-filled columns."""
    c = F.col
    return {
        "bytes_per_packet": ratio(c("TotBytes"), c("TotPkts") + 1),
        "src_dst_pkt_ratio": ratio(c("SrcPkts"), c("DstPkts") + 1),
        "src_dst_byte_ratio": ratio(c("SrcBytes"), c("DstBytes") + 1),
        "log_rate": log_volume(c("Rate")),
        "log_totbytes": log_volume(c("TotBytes")),
        "log_totpkts": log_volume(c("TotPkts")),
    }


def add_engineered(df: DataFrame) -> DataFrame:
    return df.withColumns(engineered_columns())


def vocabulary(
    df: DataFrame, columns: tuple[str, ...] = contract.CATEGORICAL, max_levels: int = MAX_LEVELS
) -> dict[str, list[str]]:
    """Sorted levels of each categorical column, found in one pass.

    Every level becomes a column of the matrix, so a table with more levels than
    a matrix can hold (``max_levels`` over all columns) is refused rather than cut.
    """
    present = [name for name in columns if name in df.columns]
    pairs = F.explode(
        F.array(*[F.struct(F.lit(n).alias("name"), quoted(n).cast("string").alias("level")) for n in present])
    )
    levels = df.select(pairs.alias("p")).select("p.*").filter("level IS NOT NULL").distinct()
    rows = levels.limit(max_levels + 1).collect()
    if len(rows) > max_levels:
        raise ValueError(f"more than {max_levels} category levels; these columns cannot be one-hot encoded")
    return {name: sorted(r["level"] for r in rows if r["name"] == name) for name in present}


def one_hot(levels: dict[str, list[str]]) -> dict[str, Column]:
    """One 0/1 column per known level; unknown and null values get zeros everywhere."""
    return {
        f"{name}_{level}": F.when(quoted(name) == level, 1.0).otherwise(0.0)
        for name, values in levels.items()
        for level in values
    }


@dataclass(frozen=True)
class FlowEncoder:
    """A fitted vocabulary and column order."""

    levels: dict[str, list[str]] = field(default_factory=dict)
    engineer: bool = False

    @classmethod
    def fit(cls, df: DataFrame, engineer: bool = False) -> "FlowEncoder":
        return cls(vocabulary(contract.contract_case(df)), engineer)

    @property
    def columns(self) -> list[str]:
        dummies = [f"{name}_{level}" for name, values in self.levels.items() for level in values]
        extra = list(ENGINEERED) if self.engineer else []
        return [*contract.NUMERIC, *contract.INDICATORS, *dummies, *extra]

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """The matrix as double columns in training order, after the ``keep`` columns.

        Columns that the table lacks are 0.0 and unknown ones are left out. A
        table without any contract column is an error: it would score every row
        alike.
        """
        df = contract.contract_case(df)
        if not set(df.columns) & set(contract.FEATURE_NAMES):
            raise ValueError("none of the contract's feature columns is in the table")
        filled = fill_sentinel(add_indicators(df))
        made = one_hot({n: v for n, v in self.levels.items() if n in df.columns})
        if self.engineer:
            made |= {
                name: column for name, column in engineered_columns().items()
                if set(_inputs(name)) <= set(df.columns)
            }
        return filled.select(
            *[quoted(name) for name in keep or []],
            *align(self.columns, {name: quoted(name) for name in filled.columns} | made),
        )

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> "FlowEncoder":
        return cls(**json.loads(text))


def _inputs(name: str) -> tuple[str, ...]:
    return {
        "bytes_per_packet": ("TotBytes", "TotPkts"),
        "src_dst_pkt_ratio": ("SrcPkts", "DstPkts"),
        "src_dst_byte_ratio": ("SrcBytes", "DstBytes"),
        "log_rate": ("Rate",),
        "log_totbytes": ("TotBytes",),
        "log_totpkts": ("TotPkts",),
    }[name]


def align(names: list[str], available: dict[str, Column]) -> list[Column]:
    """Columns in a given order as doubles, 0.0 for what is not available."""
    return [available.get(name, F.lit(0.0)).cast("double").alias(name) for name in names]
