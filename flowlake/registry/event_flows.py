"""Shapes the generic ``events`` table into contract flows.

The mapping is invented for checks on the given tables. The same text is valid
in Spark SQL and in ANSI SQL but for the JSON access and the string cast, so
the two dialects are produced from one template.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_BASE = """
SELECT event_id AS eid, ts, user_id, event_type, value, {k} AS k FROM events
"""

_TYPED = """
SELECT *,
  CASE event_type
    WHEN 'view' THEN 'Benign'
    WHEN 'signup' THEN CASE WHEN k < 50 THEN 'Benign' ELSE 'UDPScan' END
    WHEN 'purchase' THEN CASE WHEN k < 70 THEN 'Benign' ELSE 'SlowrateDoS' END
    WHEN 'click' THEN CASE WHEN k < 60 THEN 'UDPFlood' ELSE 'HTTPFlood' END
    WHEN 'error' THEN CASE WHEN k < 40 THEN 'SYNFlood' WHEN k < 45 THEN 'ICMPFlood'
                           WHEN k < 75 THEN 'SYNScan' ELSE 'TCPConnectScan' END
  END AS attack_type
FROM base
"""

_NAMED = """
SELECT *,
  CASE WHEN attack_type = 'Benign' THEN 'Benign' ELSE 'Malicious' END AS label,
  CASE WHEN attack_type = 'Benign' THEN 'Benign'
       WHEN attack_type IN ('UDPFlood', 'ICMPFlood', 'SYNFlood') THEN 'Hping3'
       WHEN attack_type = 'HTTPFlood' THEN 'Goldeneye'
       WHEN attack_type = 'SlowrateDoS' THEN CASE WHEN eid % 2 = 0 THEN 'Slowloris' ELSE 'Torshammer' END
       ELSE 'Nmap' END AS attack_tool,
  CASE WHEN attack_type = 'ICMPFlood' THEN 'icmp'
       WHEN attack_type IN ('UDPFlood', 'UDPScan') THEN 'udp'
       WHEN attack_type = 'Benign' AND k % 4 = 0 THEN 'udp'
       WHEN attack_type = 'Benign' AND k % 4 = 1 THEN 'icmp'
       ELSE 'tcp' END AS proto
FROM typed
"""

_FLOWS = """
SELECT
  concat('evt_', lpad(CAST(eid AS {string}), 8, '0')) AS event_id,
  ts AS ingestion_timestamp,
  '1.0.1' AS schema_version,
  value / 10 AS {q}Dur{q},
  proto AS {q}Proto{q},
  CASE WHEN eid % 3 = 0 THEN 'Start' WHEN eid % 3 = 1 THEN 'Status' ELSE 'Shutdown' END AS {q}Cause{q},
  CASE WHEN proto = 'icmp' THEN 'ECO' WHEN proto = 'udp' THEN 'INT'
       WHEN eid % 3 = 0 THEN 'CON' WHEN eid % 3 = 1 THEN 'FIN' ELSE 'RST' END AS {q}State{q},
  CASE WHEN eid % 97 <> 0 THEN CAST(k % 3 * 8 AS double) END AS {q}sTos{q},
  CASE WHEN k < 23 THEN CAST(k % 2 * 4 AS double) END AS {q}dTos{q},
  CASE WHEN eid % 97 = 0 THEN NULL WHEN k % 4 = 0 THEN 'cs0' WHEN k % 4 = 1 THEN 'af11'
       WHEN k % 4 = 2 THEN 'ef' ELSE 'cs6' END AS {q}sDSb{q},
  CASE WHEN k < 23 THEN CASE WHEN k % 2 = 0 THEN 'cs0' ELSE 'cs6' END END AS {q}dDSb{q},
  CASE WHEN eid % 97 <> 0 THEN CAST(64 - user_id % 5 AS double) END AS {q}sTtl{q},
  CASE WHEN k < 23 THEN CAST(64 - k % 3 AS double) END AS {q}dTtl{q},
  CASE WHEN attack_type IN ('SYNScan', 'UDPScan') THEN CAST(17 AS double)
       ELSE CAST(1 + user_id % 4 AS double) END AS {q}sHops{q},
  CASE WHEN k < 23 THEN CAST(1 + k % 5 AS double) END AS {q}dHops{q},
  1 + k AS {q}TotPkts{q},
  1 + k - CASE WHEN k < 23 THEN k % 7 ELSE 0 END AS {q}SrcPkts{q},
  CASE WHEN k < 23 THEN k % 7 ELSE 0 END AS {q}DstPkts{q},
  CAST(floor(value * 100) AS bigint) AS {q}TotBytes{q},
  CAST(floor(value * 100) AS bigint)
    - CASE WHEN k < 23 THEN CAST(floor(value * 25) AS bigint) ELSE 0 END AS {q}SrcBytes{q},
  CASE WHEN k < 23 THEN CAST(floor(value * 25) AS bigint) ELSE 0 END AS {q}DstBytes{q},
  CAST(40 + k % 50 AS double) AS {q}sMeanPktSz{q},
  CASE WHEN k < 23 THEN CAST(30 + k % 20 AS double) ELSE CAST(0 AS double) END AS {q}dMeanPktSz{q},
  value * 8 AS {q}Load{q},
  value * 6 AS {q}SrcLoad{q},
  CASE WHEN k < 23 THEN value * 2 ELSE CAST(0 AS double) END AS {q}DstLoad{q},
  CASE WHEN eid % 5 = 0 THEN k % 3 ELSE 0 END AS {q}Loss{q},
  CASE WHEN eid % 5 = 0 THEN k % 3 ELSE 0 END AS {q}SrcLoss{q},
  CAST(0 AS bigint) AS {q}DstLoss{q},
  CASE WHEN eid % 5 = 0 THEN CAST(k % 3 AS double) / CAST(1 + k AS double)
       ELSE CAST(0 AS double) END AS {q}pLoss{q},
  CASE WHEN proto = 'tcp' THEN CAST(k % 4 AS double) END AS {q}SrcGap{q},
  CASE WHEN proto = 'tcp' AND k < 23 THEN CAST(k % 2 AS double) END AS {q}DstGap{q},
  CAST(1 + k AS double) / (value + 1) AS {q}Rate{q},
  CAST(1 + k AS double) / (value + 2) AS {q}SrcRate{q},
  CASE WHEN k < 23 THEN CAST(k % 7 AS double) / (value + 1) ELSE CAST(0 AS double) END AS {q}DstRate{q},
  CASE WHEN proto = 'tcp' THEN CAST(1024 + k * 512 AS double) END AS {q}SrcWin{q},
  CASE WHEN proto = 'tcp' AND k < 23 THEN CAST(2048 + k * 256 AS double) END AS {q}DstWin{q},
  CASE WHEN proto = 'tcp' THEN CAST(user_id * 7919 + k AS double) END AS {q}SrcTCPBase{q},
  CASE WHEN proto = 'tcp' AND k < 23 THEN CAST(user_id * 104729 + k AS double) END AS {q}DstTCPBase{q},
  CASE WHEN proto = 'tcp' THEN value / 1000 ELSE CAST(0 AS double) END AS {q}TcpRtt{q},
  CASE WHEN proto = 'tcp' THEN value / 2000 ELSE CAST(0 AS double) END AS {q}SynAck{q},
  CASE WHEN proto = 'tcp' THEN value / 4000 ELSE CAST(0 AS double) END AS {q}AckDat{q},
  CASE WHEN proto = 'tcp' THEN 1 ELSE 0 END AS is_tcp,
  CASE WHEN k < 23 THEN 1 ELSE 0 END AS has_dst_reply,
  label AS {q}Label{q},
  attack_type,
  attack_tool,
  eid AS row_id,
  user_id AS {q}Seq{q}
FROM named
"""


def _render(k: str, string: str, quote: str) -> str:
    parts = {"base": _BASE, "typed": _TYPED, "named": _NAMED}
    ctes = ", ".join(f"{name} AS ({text})" for name, text in parts.items())
    text = f"{ctes}, flows AS ({_FLOWS})"
    return text.format(k=k, string=string, q=quote)


def flows_sql() -> str:
    """ANSI common table expressions ending in ``flows``; put ``WITH`` in front."""
    return _render("CAST(json_extract_string(props, '$.k') AS bigint)", "varchar", '"')


def event_flows(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Contract flows plus ``row_id`` (file order) and ``Seq`` from an ``events`` table."""
    text = _render("CAST(get_json_object(props, '$.k') AS bigint)", "string", "`")
    ctes = text.replace("FROM events", "FROM {events}")
    return spark.sql(f"WITH {ctes} SELECT * FROM flows", events=events)
