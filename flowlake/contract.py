"""The flow contract, and every schema that is derived from it.

Readers, the streaming parser, table definitions, quality suites and the model
matrix all take their columns from here, so a contract change is one edit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

@dataclass(frozen=True)
class Feature:
    name: str
    kind: str
    nullable: bool = False


# --------------------------------------------------------------------------
# Names, kinds and nullability must equal the published contract.
# One feature per line: name, kind, and whether a value may be absent.
FEATURES = (
    Feature("Dur", "float"),
    Feature("Proto", "category"),
    Feature("Cause", "category"),
    Feature("State", "category"),
    Feature("sTos", "float", nullable=True),
    Feature("dTos", "float", nullable=True),
    Feature("sDSb", "category", nullable=True),
    Feature("dDSb", "category", nullable=True),
    Feature("sTtl", "float", nullable=True),
    Feature("dTtl", "float", nullable=True),
    Feature("sHops", "float", nullable=True),
    Feature("dHops", "float", nullable=True),
    Feature("TotPkts", "int"),
    Feature("SrcPkts", "int"),
    Feature("DstPkts", "int"),
    Feature("TotBytes", "int"),
    Feature("SrcBytes", "int"),
    Feature("DstBytes", "int"),
    Feature("sMeanPktSz", "float"),
    Feature("dMeanPktSz", "float"),
    Feature("Load", "float"),
    Feature("SrcLoad", "float"),
    Feature("DstLoad", "float"),
    Feature("Loss", "int"),
    Feature("SrcLoss", "int"),
    Feature("DstLoss", "int"),
    Feature("pLoss", "float"),
    Feature("SrcGap", "float", nullable=True),
    Feature("DstGap", "float", nullable=True),
    Feature("Rate", "float"),
    Feature("SrcRate", "float"),
    Feature("DstRate", "float"),
    Feature("SrcWin", "float", nullable=True),
    Feature("DstWin", "float", nullable=True),
    Feature("SrcTCPBase", "float", nullable=True),
    Feature("DstTCPBase", "float", nullable=True),
    Feature("TcpRtt", "float"),
    Feature("SynAck", "float"),
    Feature("AckDat", "float"),
)
SCHEMA_VERSION = "1.0.1"
NULL_SENTINEL = -1.0
DROPPED = ("Unnamed: 0", "Seq", "RunTime", "Mean", "Sum", "Min", "Max", "sVid", "dVid", "Offset")
LABELS = ("Label", "Attack Type", "Attack Tool")
LABEL_RENAMES = {"Attack Type": "attack_type", "Attack Tool": "attack_tool"}
INDICATORS = ("is_tcp", "has_dst_reply")
ENVELOPE = ("event_id", "ingestion_timestamp", "schema_version")
PROTOCOLS = ("icmp", "udp", "tcp", "sctp", "arp", "llc", "lldp", "ipv6-icmp")
CAUSES = ("Start", "Status", "Shutdown")
BINARY_LABELS = ("Benign", "Malicious")
ATTACK_TYPES = (
    "Benign", "UDPFlood", "HTTPFlood", "SlowrateDoS", "TCPConnectScan",
    "SYNScan", "UDPScan", "SYNFlood", "ICMPFlood",
)
ATTACK_TOOLS = ("Benign", "Hping3", "Goldeneye", "Torshammer", "Nmap", "Slowloris")
ATTACK_CATEGORIES = {
    "Benign": "Benign",
    "UDPFlood": "DoS",
    "HTTPFlood": "DoS",
    "SlowrateDoS": "DoS",
    "SYNFlood": "DoS",
    "ICMPFlood": "DoS",
    "TCPConnectScan": "Reconnaissance",
    "SYNScan": "Reconnaissance",
    "UDPScan": "Reconnaissance",
}
# Tokens that a CSV reader should take as a missing value.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# --------------------------------------------------------------------------


FEATURE_NAMES = tuple(f.name for f in FEATURES)
NUMERIC = tuple(f.name for f in FEATURES if f.kind != "category")
CATEGORICAL = tuple(f.name for f in FEATURES if f.kind == "category")
REQUIRED = tuple(f.name for f in FEATURES if not f.nullable)
SILVER_LABELS = tuple(LABEL_RENAMES.get(name, name) for name in LABELS)
SILVER_COLUMNS = ENVELOPE + FEATURE_NAMES + INDICATORS + SILVER_LABELS
NON_FEATURES = ENVELOPE + SILVER_LABELS + LABELS + ("loaded_at", "batch_id")


@dataclass(frozen=True)
class StoredColumn:
    """A column of the parsed table, and where an event has it."""

    name: str
    kind: str
    path: tuple[str, ...]
    nullable: bool = False


#: Every column of the parsed table in order; all schemas below are views of this list.
COLUMNS = (
    *(StoredColumn(name, "time" if name == "ingestion_timestamp" else "category", (name,)) for name in ENVELOPE),
    *(StoredColumn(f.name, f.kind, ("flow", f.name), f.nullable) for f in FEATURES),
    *(StoredColumn(name, "flag", ("flow", name)) for name in INDICATORS),
    *(StoredColumn(LABEL_RENAMES.get(name, name), "category", ("flow", name)) for name in LABELS),
)
TYPES = {"float": T.DoubleType(), "int": T.LongType(), "category": T.StringType(), "flag": T.IntegerType(), "time": T.TimestampType()}
#: JSON has no times: they travel as text.
JSON_TYPES = TYPES | {"time": T.StringType()}


def _nested(columns: list[StoredColumn], depth: int = 0) -> T.StructType:
    """The object that holds the columns' paths from a depth on, in order of first mention."""
    out = T.StructType()
    for key in dict.fromkeys(c.path[depth] for c in columns):
        below = [c for c in columns if c.path[depth] == key]
        leaf = len(below[0].path) == depth + 1
        out.add(key, JSON_TYPES[below[0].kind] if leaf else _nested(below, depth + 1), leaf and below[0].nullable)
    return out


def event_schema() -> T.StructType:
    """One JSON event as it travels on the stream."""
    return _nested(list(COLUMNS))


def flow_schema() -> T.StructType:
    """The nested ``flow`` object of an event."""
    return event_schema()["flow"].dataType


def silver_schema() -> T.StructType:
    """The flat, typed table of parsed flows."""
    return T.StructType([T.StructField(c.name, TYPES[c.kind]) for c in COLUMNS])


def from_event(event: str) -> list[Column]:
    """The parsed table's columns from a column of events; an unreadable time is null."""
    out = []
    for column in COLUMNS:
        value = F.col(".".join([event, *(f"`{key}`" for key in column.path)]))
        out.append((F.try_to_timestamp(value) if column.kind == "time" else value).alias(column.name))
    return out


def raw_columns() -> tuple[str, ...]:
    """All 52 columns of a raw capture file."""
    return FEATURE_NAMES + LABELS + DROPPED


def table_ddl(table: str = "silver_flows", fmt: str = "parquet") -> str:
    """CREATE TABLE text for the parsed flows."""
    lines = [f"  `{c.name}` {TYPES[c.kind].simpleString().upper()}" + ("" if c.nullable else " NOT NULL") for c in COLUMNS]
    lines.append("  `loaded_at` TIMESTAMP")
    return f"CREATE TABLE IF NOT EXISTS {table} (\n" + ",\n".join(lines) + f"\n) USING {fmt}"


def staging_columns() -> list[Column]:
    """Lower-case projection of the parsed flows, without the load stamp."""
    return [F.col(f"`{name}`").alias(name.lower()) for name in SILVER_COLUMNS]


def staging_sql(source: str = "silver_flows") -> str:
    """The same projection as SQL text."""
    cols = ",\n".join(f"  `{name}` AS {name.lower()}" for name in SILVER_COLUMNS)
    return f"SELECT\n{cols}\nFROM {source}"


def drop_contract_columns(df: DataFrame, strict: bool = False) -> DataFrame:
    """Remove the columns that never enter the model; ``strict`` wants all of them present."""
    missing = [name for name in DROPPED if name not in df.columns]
    if strict and missing:
        raise ValueError(f"columns to drop are missing: {missing}")
    return df.drop(*DROPPED)


def rename_labels(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(LABEL_RENAMES)


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.upper() for name in df.columns])


def contract_case(df: DataFrame) -> DataFrame:
    """Give feature columns the contract's spelling whatever case they came in."""
    spelling = {name.lower(): name for name in FEATURE_NAMES}
    return df.select(
        [F.col(f"`{name}`").alias(spelling.get(name.lower(), name)) for name in df.columns]
    )


def feature_columns(df: DataFrame) -> list[str]:
    """Model inputs of a table: every column that is not a label, id or stamp."""
    skip = {name.lower() for name in NON_FEATURES}
    return [name for name in df.columns if name.lower() not in skip]


def common_columns(left: DataFrame, right: DataFrame, numeric_only: bool = False) -> list[str]:
    """Columns in both tables, in the order of the left one."""
    names = [name for name in left.columns if name in right.columns]
    if numeric_only:
        numeric = set(columns_of_kind(left, "number"))
        names = [name for name in names if name in numeric]
    return names


def columns_of_kind(df: DataFrame, kind: str) -> list[str]:
    """Column names by type class: ``number`` or ``category`` (string and boolean)."""
    classes = {"number": (T.NumericType,), "category": (T.StringType, T.BooleanType)}
    return [f.name for f in df.schema if isinstance(f.dataType, classes[kind])]
