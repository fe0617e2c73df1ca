"""The same results in plain DuckDB SQL over the shared test tables.

Each statement is assembled from named steps; a step lists the steps it reads. The steps
state what is meant in the most direct way (global window, plain self-join), on purpose
unlike the Spark jobs they check.
"""

from __future__ import annotations

from ringtrail import constants as K
from ringtrail import schemas
from ringtrail.config import ASSESSMENTS, CIRCULAR_FLOW, LAUNDERING_EXPOSURE, MULE_HUB, OTHER_RINGS, SECOND_LOAD, rings_of
from ringtrail.operators import reads

HOURS = "CAST((epoch_us({b}) - epoch_us({a}) + 1800000000) // 3600000000 AS BIGINT)"


def _hours(a: str, b: str) -> str:
    return HOURS.format(a=a, b=b)


def _text(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else "'" + value.replace("'", "''") + "'"


def _controls(cfg) -> str:
    keys = {"control_bsa": "BSA", "control_fatf": "FATF", "control_eu_amld": "EU_AMLD"}
    return ", ".join(f"{_text(cfg.control_mapping[k])} AS {c}" for c, k in keys.items())


def _case_rank(expr: str) -> str:
    whens = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(K.SEVERITY_ORDER))
    return f"CASE {expr} {whens} ELSE {len(K.SEVERITY_ORDER)} END"


# name -> (steps it reads, SQL)
STEPS: dict[str, tuple[list[str], str]] = {}


def _step(name: str, reads_from: str, sql: str) -> None:
    STEPS[name] = (reads_from.split(), sql.strip())


# --- derived input tables (FIXTURES.md) ---------------------------------------------------

_step("n", "", "SELECT count(*)::BIGINT AS c FROM customer")
_step("hops", "", "SELECT * FROM (VALUES (1,0,0,7),(2,1,7,13),(3,2,13,0)) h(hop,d,f,t)")
_step(
    "ordinary",
    "n",
    """
SELECT l.l_shipdate AS event_timestamp,
       (o.o_custkey*o.o_custkey)//n.c AS fa,
       ((l.l_partkey%n.c)*(l.l_partkey%n.c))//n.c AS ta,
       CAST(l.l_extendedprice AS DECIMAL(20,2)) * CAST(1-l.l_discount AS DECIMAL(4,2)) AS amount_received,
       CAST(l.l_extendedprice AS DECIMAL(20,4)) AS amount_paid,
       l.l_returnflag AS ccy, l.l_linestatus AS pf,
       CASE WHEN (l.l_orderkey*7+l.l_linenumber)%50=0 THEN 1 ELSE 0 END AS is_laundering
FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey CROSS JOIN n
""",
)
_step(
    "planted",
    "n hops",
    """
SELECT o.o_orderdate + CASE WHEN o.o_orderkey%125=0 AND h.hop=3 THEN INTERVAL 20 DAY ELSE h.d*INTERVAL 30 HOUR END AS event_timestamp,
       (o.o_custkey+h.f)%n.c AS fa, (o.o_custkey+h.t)%n.c AS ta,
       CAST(o.o_totalprice AS DECIMAL(20,2)) AS px,
       CASE WHEN h.hop<3 THEN CAST(1.00 AS DECIMAL(4,2))
            WHEN o.o_orderkey%4=0 THEN CAST(1.05 AS DECIMAL(4,2))
            WHEN o.o_orderkey%4=1 THEN CAST(1.30 AS DECIMAL(4,2))
            WHEN o.o_orderkey%4=2 THEN CAST(1.50 AS DECIMAL(4,2))
            ELSE CAST(1.60 AS DECIMAL(4,2)) END AS k,
       CASE WHEN o.o_orderkey%8=4 AND h.hop=2 THEN 'F' ELSE 'O' END AS pf,
       CASE WHEN o.o_orderkey%3=0 AND h.hop=3 THEN 0 WHEN o.o_orderkey%7=0 THEN 0 ELSE 1 END AS is_laundering
FROM orders o CROSS JOIN hops h CROSS JOIN n
WHERE o.o_orderkey%25=0
""",
)
_CCY = "CASE ccy WHEN 'A' THEN 'US Dollar' WHEN 'N' THEN 'Euro' ELSE 'Saudi Riyal' END"
_step(
    "txn",
    "ordinary planted",
    f"""
SELECT event_timestamp,
       'B'||lpad((fa%25)::VARCHAR,2,'0') AS from_bank, fa::VARCHAR AS from_account,
       'B'||lpad((ta%25)::VARCHAR,2,'0') AS to_bank,   ta::VARCHAR AS to_account,
       CAST(amount_received AS DECIMAL(20,4)) AS amount_received, {_CCY} AS receiving_currency,
       amount_paid, {_CCY} AS payment_currency,
       CASE pf WHEN 'O' THEN 'ACH' ELSE 'Wire' END AS payment_format,
       CAST(is_laundering AS SMALLINT) AS is_laundering
FROM (SELECT event_timestamp,fa,ta,amount_received,amount_paid,ccy,pf,is_laundering FROM ordinary
      UNION ALL
      SELECT event_timestamp,fa,ta,CAST(px*k AS DECIMAL(20,4)),CAST(px*k AS DECIMAL(20,4)),'R',pf,is_laundering FROM planted) u
""",
)
_step(
    "ledger",
    "",
    """
SELECT 'Bank of '||n.n_name AS bank_name, 'B'||lpad((c.c_custkey%25)::VARCHAR,2,'0') AS bank_id,
       c.c_custkey::VARCHAR AS account_id, 'E'||(c.c_custkey//6)::VARCHAR AS entity_id,
       'Entity #'||(c.c_custkey//6)::VARCHAR AS entity_name
FROM customer c JOIN nation n ON n.n_nationkey = c.c_custkey%25
WHERE c.c_custkey%3=0
""",
)

# --- graph ---------------------------------------------------------------------------------

_step(
    "xfer",
    "txn",
    """
SELECT row_number() OVER (ORDER BY event_timestamp, from_bank, from_account, to_bank, to_account, amount_paid,
           amount_received, receiving_currency, payment_currency, payment_format) AS id,
       from_bank||':'||from_account AS src, to_bank||':'||to_account AS dst,
       event_timestamp AS ts, amount_paid AS amt, payment_currency AS ccy, payment_format AS pf,
       is_laundering AS lab, amount_received, receiving_currency
FROM txn
""",
)
_step(
    "seen",
    "txn",
    """
SELECT DISTINCT unnest([from_bank, to_bank]) AS bank_id, unnest([from_account, to_account]) AS account_id FROM txn
""",
)
_step(
    "bank",
    "seen ledger",
    """
SELECT fse_id, coalesce(max(bank_name), 'Bank '||fse_id) AS name
FROM (SELECT bank_id AS fse_id, bank_name FROM ledger UNION ALL SELECT bank_id, NULL FROM seen) u GROUP BY fse_id
""",
)
_step(
    "acct",
    "seen ledger",
    """
SELECT bank_id||':'||account_id AS account_key, bank_id, account_id
FROM (SELECT bank_id, account_id FROM ledger UNION SELECT bank_id, account_id FROM seen) u
""",
)
_step(
    "person",
    "seen ledger",
    f"""
SELECT party_id, arg_min(src, rank) AS record_source, coalesce(min(name) FILTER (rank = 0), min(name)) AS name
FROM (SELECT entity_id AS party_id, '{K.ACCOUNTS_SOURCE}' AS src, 0 AS rank, entity_name AS name FROM ledger
      UNION ALL
      SELECT bank_id||':'||account_id, '{K.SYNTHESIZED_SOURCE}', 1, bank_id||':'||account_id FROM seen) u
GROUP BY party_id
""",
)
_step(
    "owns",
    "seen ledger",
    f"""
SELECT party_id, account_key, min(source) AS source
FROM (SELECT entity_id AS party_id, bank_id||':'||account_id AS account_key, '{K.ACCOUNTS_SOURCE}' AS source FROM ledger
      UNION ALL
      SELECT bank_id||':'||account_id, bank_id||':'||account_id, '{K.SYNTHESIZED_SOURCE}' FROM seen) u
GROUP BY party_id, account_key
""",
)

# --- circular flow -----------------------------------------------------------------------------

_step(
    "ring",
    "xfer",
    """
SELECT row_number() OVER (ORDER BY x.ts, x.id, y.id, z.id) AS finding_id,
       x.id AS i1, y.id AS i2, z.id AS i3, x.src AS a, y.src AS b, z.src AS c,
       x.ts AS t1, y.ts AS t2, z.ts AS t3, x.amt AS m1, y.amt AS m2, z.amt AS m3, x.ccy AS ccy,
       x.pf AS p1, y.pf AS p2, z.pf AS p3,
       least(x.amt, y.amt, z.amt) AS lo, greatest(x.amt, y.amt, z.amt) AS hi
FROM xfer x
JOIN xfer y ON y.src = x.dst AND y.ccy = x.ccy AND y.ts BETWEEN x.ts AND x.ts + INTERVAL 14 DAY
JOIN xfer z ON z.src = y.dst AND z.dst = x.src AND z.ccy = x.ccy AND z.ts BETWEEN y.ts AND x.ts + INTERVAL 14 DAY
WHERE x.amt > 1000 AND y.amt > 1000 AND z.amt > 1000
  AND x.src <> x.dst AND y.src <> y.dst AND z.src <> z.dst
  AND greatest(x.amt, y.amt, z.amt) <= 1.5 * least(x.amt, y.amt, z.amt)
""",
)
_step(
    "ring_finding",
    "ring",
    f"""
SELECT finding_id, '{K.CIRCULAR_FLOW}' AS assessment_id, 'CIRCULAR_FLOW' AS finding_type,
       CASE WHEN p1 = p2 AND p2 = p3 AND hi <= 1.2 * lo THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
       '3-hop circular fund flow: '||a||' -> '||b||' -> '||c||' -> '||a AS title,
       'Ring of 3 distinct accounts returning funds to origin over '||{_hours("t1", "t3")}
           ||' hours. Amount range '||lo::VARCHAR||'-'||hi::VARCHAR||' '||ccy||'.' AS description,
       3::BIGINT AS hops, ccy AS currency, lo::DOUBLE AS amount_min, hi::DOUBLE AS amount_max,
       round(hi::DOUBLE / lo::DOUBLE, 4) AS amount_ratio, {_hours("t1", "t3")} AS time_span_hours,
       p1||'|'||p2||'|'||p3 AS payment_formats, a||'|'||b||'|'||c AS accounts,
       {_controls(CIRCULAR_FLOW)}, t1 AS trigger, {CIRCULAR_FLOW.sla_hours}::BIGINT AS sla_hours
FROM ring
""",
)
_step(
    "ring_entity",
    "ring owns acct",
    f"""
WITH member AS (SELECT finding_id, unnest([a, b, c]) AS k FROM ring)
SELECT finding_id, 'Account' AS entity_type, k AS entity_id, '{K.RING_MEMBER}' AS role FROM member
UNION SELECT finding_id, 'Party', party_id, '{K.ACCOUNT_OWNER}' FROM member JOIN owns ON account_key = k
UNION SELECT finding_id, 'FinancialInstitution', bank_id, '{K.CUSTODIAN_BANK}' FROM member JOIN acct ON account_key = k
""",
)
_step(
    "ring_edge",
    "ring",
    """
SELECT finding_id, unnest([1, 2, 3])::BIGINT AS hop_order, unnest([a, b, c]) AS src, unnest([b, c, a]) AS dst,
       unnest([i1, i2, i3]) AS id, unnest([m1, m2, m3]) AS amt, ccy, unnest([t1, t2, t3]) AS ts, unnest([p1, p2, p3]) AS pf,
       CAST(NULL AS VARCHAR) AS direction
FROM ring
""",
)

# --- mule hub ------------------------------------------------------------------------------------

for _side, _key, _other in (("out", "src", "dst"), ("in", "dst", "src")):
    _step(
        f"{_side}_degree",
        "xfer",
        f"""
SELECT {_key} AS account_key, count(DISTINCT {_other}) AS {_side}_deg, count(*) AS {_side}_cnt, sum(amt) AS {_side}_total,
       min(ts) AS {_side}_first, max(ts) AS {_side}_last
FROM xfer GROUP BY {_key}
""",
    )
_step(
    "touch",
    "xfer",
    "SELECT unnest([src, dst]) AS account_key, unnest(['outbound', 'inbound']) AS side, unnest([dst, src]) AS other, * FROM xfer",
)
_step(
    "main_currency",
    "touch",
    """
SELECT account_key, ccy FROM touch GROUP BY account_key, ccy
QUALIFY row_number() OVER (PARTITION BY account_key ORDER BY count(*) DESC, ccy) = 1
""",
)
_step("ring_count", "ring", "SELECT count(*) AS c FROM ring")
_step(
    "hub",
    "in_degree out_degree main_currency ring_count",
    """
SELECT (SELECT c FROM ring_count) + row_number() OVER (ORDER BY in_deg + out_deg DESC, account_key) AS finding_id,
       account_key, in_deg, out_deg, in_cnt, out_cnt, in_total, out_total,
       least(in_first, out_first) AS t_first, greatest(in_last, out_last) AS t_last, ccy,
       least(in_total, out_total) AS lo, greatest(in_total, out_total) AS hi
FROM in_degree JOIN out_degree USING (account_key) LEFT JOIN main_currency USING (account_key)
WHERE in_deg >= 10 AND out_deg >= 10
""",
)
_step(
    "hub_finding",
    "hub",
    f"""
SELECT finding_id, '{K.MULE_HUB}' AS assessment_id, 'MULE_HUB' AS finding_type,
       CASE WHEN least(in_deg, out_deg) >= 50 THEN 'CRITICAL' WHEN least(in_deg, out_deg) >= 20 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
       'Mule hub '||account_key||' ('||in_deg||' in / '||out_deg||' out counterparties)' AS title,
       'Account '||account_key||' received from '||in_deg||' distinct counterparties and dispersed to '||out_deg
           ||' distinct counterparties over '||{_hours("t_first", "t_last")}||' hours.' AS description,
       ccy AS currency, in_deg AS in_degree, out_deg AS out_degree, in_cnt AS in_txn_count, out_cnt AS out_txn_count,
       in_total::DOUBLE AS in_amount_total, out_total::DOUBLE AS out_amount_total,
       CASE WHEN in_total > 0 THEN round(out_total::DOUBLE / in_total::DOUBLE, 4) END AS balance_ratio,
       lo::DOUBLE AS amount_min, hi::DOUBLE AS amount_max, {_hours("t_first", "t_last")} AS time_span_hours,
       {_controls(MULE_HUB)}, t_first AS trigger, {MULE_HUB.sla_hours}::BIGINT AS sla_hours
FROM hub
""",
)
_step(
    "hub_cpty",
    "hub touch",
    """
SELECT finding_id, side, row_number() OVER (PARTITION BY finding_id, side ORDER BY sum(amt) DESC, other) AS rank,
       other, sum(amt) AS total
FROM hub JOIN touch USING (account_key) GROUP BY finding_id, side, other QUALIFY rank <= 5
""",
)


def _detector_steps(prefix: str, anchors: str, cpty: str, own_role: str) -> None:
    roles = [own_role, K.ACCOUNT_OWNER, K.CUSTODIAN_BANK, K.INBOUND_COUNTERPARTY, K.OUTBOUND_COUNTERPARTY]
    _step(
        f"{prefix}_entity",
        f"{anchors} {cpty} owns acct",
        f"""
SELECT finding_id, entity_type, entity_id, {roles}[min(r)] AS role
FROM (SELECT finding_id, 'Account' AS entity_type, account_key AS entity_id, 1 AS r FROM {anchors}
      UNION ALL SELECT finding_id, 'Party', party_id, 2 FROM {anchors} JOIN owns USING (account_key)
      UNION ALL SELECT finding_id, 'FinancialInstitution', bank_id, 3 FROM {anchors} JOIN acct USING (account_key)
      UNION ALL SELECT finding_id, 'Account', other, CASE side WHEN 'inbound' THEN 4 ELSE 5 END FROM {cpty}) u
GROUP BY finding_id, entity_type, entity_id
""",
    )


def _edge_step(prefix: str, anchors: str, touches: str) -> None:
    _step(
        f"{prefix}_edge",
        f"{anchors} {touches}",
        f"""
WITH best AS (
    SELECT finding_id, side, src, dst, id, amt, t.ccy, ts, pf,
           row_number() OVER (PARTITION BY finding_id, side ORDER BY amt DESC, id) AS rank
    FROM {anchors} JOIN {touches} t USING (account_key) QUALIFY rank <= 5)
SELECT finding_id, row_number() OVER (PARTITION BY finding_id ORDER BY side, rank) AS hop_order,
       src, dst, id, amt, ccy, ts, pf, side AS direction
FROM best
""",
    )


_detector_steps("hub", "hub", "hub_cpty", K.HUB_ROLE)
_edge_step("hub", "hub", "touch")

# --- exposure --------------------------------------------------------------------------------------

_step(
    "marked",
    "xfer txn",
    """
SELECT x.* FROM xfer x JOIN txn b
  ON b.event_timestamp = x.ts AND b.from_bank||':'||b.from_account = x.src
 AND b.to_bank||':'||b.to_account = x.dst AND b.amount_paid = x.amt
WHERE b.is_laundering = 1
""",
)
_step(
    "mark_touch",
    "marked",
    "SELECT unnest([src, dst]) AS account_key, unnest(['outbound', 'inbound']) AS side, unnest([dst, src]) AS other, * FROM marked",
)
_step(
    "mark_currency",
    "mark_touch",
    """
SELECT account_key, ccy FROM mark_touch GROUP BY account_key, ccy
QUALIFY row_number() OVER (PARTITION BY account_key ORDER BY count(*) DESC, ccy) = 1
""",
)
_step("hub_count", "hub ring_count", "SELECT (SELECT c FROM ring_count) + count(*) AS c FROM hub")
_step(
    "exposed",
    "mark_touch mark_currency hub_count",
    """
WITH per_account AS (
    SELECT account_key, count(*) AS edges, count(DISTINCT id) AS txns, sum(amt) AS total, min(amt) AS lo, max(amt) AS hi,
           min(ts) AS t_first, max(ts) AS t_last
    FROM mark_touch GROUP BY account_key HAVING count(*) >= 20)
SELECT (SELECT c FROM hub_count) + row_number() OVER (ORDER BY edges DESC, account_key) AS finding_id, *
FROM per_account LEFT JOIN mark_currency USING (account_key)
""",
)
_step(
    "exposed_finding",
    "exposed",
    f"""
SELECT finding_id, '{K.LAUNDERING_EXPOSURE}' AS assessment_id, 'LAUNDERING_EXPOSURE' AS finding_type,
       CASE WHEN edges >= 50 THEN 'CRITICAL' WHEN edges >= 30 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
       'Labeled exposure: '||account_key||' ('||edges||' labeled transfers)' AS title,
       'Account '||account_key||' participates in '||edges||' transactions flagged IsLaundering=1 by the AMLSim ground-truth label. '
           ||'Label-driven, supervised — contrast with graph-native assessments.' AS description,
       ccy AS currency, edges AS labeled_edges, txns AS distinct_labeled_txns, total::DOUBLE AS labeled_amount_total,
       lo::DOUBLE AS amount_min, hi::DOUBLE AS amount_max, {_hours("t_first", "t_last")} AS time_span_hours,
       {_controls(LAUNDERING_EXPOSURE)}, t_first AS trigger, {LAUNDERING_EXPOSURE.sla_hours}::BIGINT AS sla_hours
FROM exposed
""",
)
_step(
    "exposed_cpty",
    "exposed mark_touch",
    """
SELECT finding_id, side, row_number() OVER (PARTITION BY finding_id, side ORDER BY sum(amt) DESC, other) AS rank,
       other, sum(amt) AS total
FROM exposed JOIN mark_touch USING (account_key) GROUP BY finding_id, side, other QUALIFY rank <= 3
""",
)
_detector_steps("exposed", "exposed", "exposed_cpty", K.EXPOSED_ROLE)
_edge_step("exposed", "exposed", "mark_touch")

# --- all findings and gold ----------------------------------------------------------------------------

_COMMON = "finding_id, assessment_id, finding_type, severity, title, description, currency, amount_min, amount_max, time_span_hours, control_bsa, control_fatf, control_eu_amld, trigger, sla_hours"
_step(
    "finding",
    "ring_finding hub_finding exposed_finding",
    f"""
SELECT {_COMMON}, hops, amount_ratio FROM ring_finding
UNION ALL SELECT {_COMMON}, NULL, NULL FROM hub_finding
UNION ALL SELECT {_COMMON}, NULL, NULL FROM exposed_finding
""",
)
_step(
    "entity",
    "ring_entity hub_entity exposed_entity",
    f"""
SELECT *, '{K.CIRCULAR_FLOW}' AS assessment_id FROM ring_entity
UNION ALL SELECT *, '{K.MULE_HUB}' FROM hub_entity
UNION ALL SELECT *, '{K.LAUNDERING_EXPOSURE}' FROM exposed_entity
""",
)
_step(
    "edge",
    "ring_edge hub_edge exposed_edge",
    f"""
SELECT *, '{K.CIRCULAR_FLOW}' AS assessment_id FROM ring_edge
UNION ALL SELECT *, '{K.MULE_HUB}' FROM hub_edge
UNION ALL SELECT *, '{K.LAUNDERING_EXPOSURE}' FROM exposed_edge
""",
)
_step(
    "owner",
    "entity owns",
    """
SELECT e.finding_id, e.entity_id AS account_key, min(o.party_id) AS owner_party_id
FROM entity e JOIN owns o ON e.entity_type = 'Account' AND o.account_key = e.entity_id
WHERE EXISTS (FROM entity p WHERE p.finding_id = e.finding_id AND p.entity_type = 'Party' AND p.entity_id = o.party_id)
GROUP BY ALL
""",
)
_step(
    "g_entity",
    "entity person bank acct owner",
    """
SELECT e.finding_id, e.entity_type, e.entity_id, e.role,
       CASE e.entity_type WHEN 'Party' THEN p.name WHEN 'Account' THEN e.entity_id ELSE b.name END AS display_name,
       CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS risk_tier, a.bank_id, b.name AS bank_name, o.owner_party_id
FROM entity e
LEFT JOIN person p ON e.entity_type = 'Party' AND p.party_id = e.entity_id
LEFT JOIN acct a ON e.entity_type = 'Account' AND a.account_key = e.entity_id
LEFT JOIN bank b ON b.fse_id = CASE e.entity_type WHEN 'Account' THEN a.bank_id WHEN 'FinancialInstitution' THEN e.entity_id END
LEFT JOIN owner o ON e.entity_type = 'Account' AND o.finding_id = e.finding_id AND o.account_key = e.entity_id
""",
)
_step(
    "g_finding",
    "finding g_entity",
    """
WITH summary AS (
    SELECT finding_id, count(*) FILTER (entity_type = 'Party') AS party_count,
           count(*) FILTER (entity_type = 'FinancialInstitution') AS bank_count,
           string_agg(DISTINCT bank_name, '|' ORDER BY bank_name) FILTER (entity_type = 'FinancialInstitution') AS banks
    FROM g_entity GROUP BY finding_id)
SELECT finding_id, assessment_id, finding_type, severity, title, description, hops AS hop_count, currency, amount_min, amount_max,
       amount_ratio, time_span_hours, control_bsa, control_fatf, control_eu_amld, trigger::VARCHAR AS sla_trigger_date,
       (trigger + sla_hours * INTERVAL 1 HOUR)::VARCHAR AS sla_due_date, sla_hours,
       coalesce(party_count, 0)::BIGINT AS party_count, coalesce(bank_count, 0)::BIGINT AS bank_count, 0::BIGINT AS country_count,
       CAST(NULL AS VARCHAR) AS countries, banks
FROM finding LEFT JOIN summary USING (finding_id)
""",
)
_step(
    "g_edge",
    "edge acct",
    """
SELECT e.finding_id, e.hop_order, 'transfers_to' AS edge_type, e.src AS from_account_key, e.dst AS to_account_key,
       s.bank_id AS from_bank_id, d.bank_id AS to_bank_id, e.id AS fin_txn_id, e.amt::DOUBLE AS amount, e.ccy AS currency,
       e.ts::VARCHAR AS event_timestamp, e.pf AS payment_format
FROM edge e LEFT JOIN acct s ON s.account_key = e.src LEFT JOIN acct d ON d.account_key = e.dst
""",
)
_step(
    "flag",
    "edge xfer",
    """
SELECT DISTINCT id, rtrim(assessment_id, '_v1') AS detector, lab
FROM edge JOIN xfer USING (id)
""",
)

# --- statements: name -> (steps, SELECT) ---------------------------------------------------------------

_EDGE = "finding_id, hop_order, 'transfers_to' AS edge_type, src AS from_entity, dst AS to_entity, id AS fin_txn_id, amt::DOUBLE AS amount, ccy AS currency, ts::VARCHAR AS event_timestamp, pf AS payment_format"
_ENTITY = "finding_id, entity_type, entity_id, role"
_CPTY = "finding_id, side, rank, other AS counterparty, total::DOUBLE AS total"
_SUMMARY = ", ".join(c for c in reads.SUMMARY_COLUMNS if c != "detected_at")
_DETAIL = ", ".join("sla_hours" if c == "sla_duration" else c for c in reads.DETAIL_COLUMNS if c != "detected_at")
_LIST_ORDER = f"ORDER BY {_case_rank('severity')}, finding_id"


def _finding_sql(step: str) -> str:
    return f"SELECT * EXCLUDE (trigger), trigger::VARCHAR AS sla_trigger_date FROM {step}"


def _degree_sql(side: str) -> str:
    return f"SELECT account_key, {side}_deg, {side}_cnt, {side}_total::DOUBLE AS {side}_total, {side}_first::VARCHAR AS {side}_first, {side}_last::VARCHAR AS {side}_last FROM {side}_degree"


def _counts(pairs: list[tuple[str, str]], column: str = "rows") -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS {column} FROM {step}" for name, step in pairs)


def _map_case(expr: str, table: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in table.items())
    return f"CASE {expr} {whens} ELSE {default} END"


def _config_sql() -> str:
    rows = []
    for a in ASSESSMENTS.values():
        changed = a.assessment_id == K.CIRCULAR_FLOW
        params = []
        for f in schemas.FINDING_CONFIG.fields:
            value, kind = a.params.get(f.name), f.dataType.typeName()
            sql_type = {"integer": "BIGINT", "decimal": "DOUBLE", "boolean": "BOOLEAN"}[kind]
            params.append(f"CAST({'NULL' if value is None else value} AS {sql_type}) AS {f.name}")
        rows.append(
            f"SELECT '{a.assessment_id}' AS assessment_id, "
            f"{_text('Circular fund flow, revised' if changed else a.title)} AS title, '{a.severity_default}' AS severity_default, "
            f"{', '.join(params)}, {_controls(a)}, {24 if changed else a.sla_hours}::BIGINT AS sla_hours, "
            "'2024-01-01 00:00:00' AS created_at"
        )
    return (
        f"SELECT c.*, f.findings, (f.last_trigger + c.sla_hours * INTERVAL 1 HOUR)::VARCHAR AS last_due "
        f"FROM ({' UNION ALL '.join(rows)}) c LEFT JOIN (SELECT assessment_id, count(*) AS findings, max(trigger) AS last_trigger "
        "FROM finding GROUP BY assessment_id) f USING (assessment_id)"
    )


_GRAPH_COUNTS = [
    ("label/txn_label", "xfer"),
    ("silver/financial_institution", "bank"),
    ("silver/account", "acct"),
    ("silver/party", "person"),
    ("silver/financial_transaction", "xfer"),
    ("silver/has_account", "owns"),
    ("silver/is_held_at", "acct"),
    ("silver/has_originating_account", "xfer"),
    ("silver/has_beneficiary_account", "xfer"),
    ("silver/transfers_to", "xfer"),
]

# Keys of every table as the SQL steps know them, for the uniqueness check.
_KEYS = {
    "silver/financial_institution": ("bank", "fse_id"),
    "silver/account": ("acct", "account_key"),
    "silver/party": ("person", "party_id"),
    "silver/financial_transaction": ("xfer", "id"),
    "silver/has_account": ("owns", "party_id, account_key"),
    "silver/is_held_at": ("acct", "account_key, bank_id"),
    "silver/has_originating_account": ("xfer", "id"),
    "silver/has_beneficiary_account": ("xfer", "id"),
    "silver/transfers_to": ("xfer", "id"),
    "silver/assessment_config": ("(SELECT unnest(%s) AS a)" % list(ASSESSMENTS), "a"),
    "silver/finding": ("finding", "finding_id"),
    "silver/finding_entity": ("entity", "finding_id, entity_type, entity_id"),
    "silver/finding_edge": ("edge", "finding_id, hop_order"),
    "gold/finding": ("g_finding", "finding_id"),
    "gold/finding_entity": ("g_entity", "finding_id, entity_type, entity_id"),
    "gold/finding_edge": ("g_edge", "finding_id, hop_order"),
}


def _pk_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS duplicate_keys FROM (SELECT {k} FROM {s} GROUP BY {k} HAVING count(*) > 1) d"
        for t, (s, k) in _KEYS.items()
    )


# Child key and parent key of every reference, in the names of the SQL steps.
_REFERENCES = [
    ("acct", "bank_id", "bank", "fse_id"),
    ("owns", "party_id", "person", "party_id"),
    ("owns", "account_key", "acct", "account_key"),
    ("acct", "account_key", "acct", "account_key"),
    ("acct", "bank_id", "bank", "fse_id"),
    ("xfer", "id", "xfer", "id"),
    ("xfer", "src", "acct", "account_key"),
    ("xfer", "id", "xfer", "id"),
    ("xfer", "dst", "acct", "account_key"),
    ("xfer", "id", "xfer", "id"),
    ("xfer", "src", "acct", "account_key"),
    ("xfer", "dst", "acct", "account_key"),
    ("finding", "assessment_id", "(SELECT unnest(%s) AS assessment_id)" % list(ASSESSMENTS), "assessment_id"),
    ("entity", "finding_id", "finding", "finding_id"),
    ("edge", "finding_id", "finding", "finding_id"),
    ("edge", "id", "xfer", "id"),
    ("g_entity", "finding_id", "g_finding", "finding_id"),
    ("g_edge", "finding_id", "g_finding", "finding_id"),
]


def _fk_sql() -> str:
    parts = []
    for (child, column, parent, _), (cs, ck, ps, pk) in zip(schemas.FOREIGN_KEYS, _REFERENCES, strict=True):
        parts.append(
            f"SELECT '{child}' AS child_table, '{column}' AS column_name, '{parent}' AS parent_table, "
            f"(SELECT count(*) FROM {cs} c WHERE c.{ck} IS NOT NULL AND NOT EXISTS (FROM {ps} p WHERE p.{pk} = c.{ck})) AS orphan_rows"
        )
    return " UNION ALL ".join(parts)


def _not_null_sql() -> str:
    """The steps the layer tables come from, NULLs counted per column they were built of."""
    source = {t: s for t, (s, _) in _KEYS.items()} | {
        "bronze/transactions_raw": "txn",
        "bronze/accounts_raw": "ledger",
        "label/txn_label": "xfer",
    }
    # Column names of the layer tables that the SQL steps call differently.
    renamed = {
        "silver/financial_transaction": {"fin_txn_id": "id", "event_timestamp": "ts", "amount_paid": "amt", "payment_currency": "ccy", "payment_format": "pf"},
        "label/txn_label": {"fin_txn_id": "id", "is_laundering": "lab"},
        "silver/party": {"source_customer_id": "party_id"},
        "silver/is_held_at": {"fse_id": "bank_id"},
        "silver/has_originating_account": {"fin_txn_id": "id", "account_key": "src"},
        "silver/has_beneficiary_account": {"fin_txn_id": "id", "account_key": "dst"},
        "silver/transfers_to": {
            "fin_txn_id": "id", "from_account_key": "src", "to_account_key": "dst", "event_timestamp": "ts",
            "amount": "amt", "currency": "ccy", "payment_format": "pf",
        },
        "silver/finding_edge": {"from_entity": "src", "to_entity": "dst"},
    }
    constant = {"detected_at", "edge_type", "summary_stats"}
    parts = []
    for table in schemas.TABLES:
        for column in schemas.not_null_columns(table):
            step = source[table]
            if column in constant or table == "silver/assessment_config":
                nulls = "0::BIGINT"
            else:
                nulls = f"(SELECT count(*) FROM {step} WHERE {renamed.get(table, {}).get(column, column)} IS NULL)"
            parts.append(f"SELECT '{table}' AS table_name, '{column}' AS column_name, {nulls} AS nulls")
    return " UNION ALL ".join(parts)


def _statements() -> dict[str, tuple[str, str]]:
    gold = "g_finding g_entity g_edge"
    layers = [
        ("bronze/transactions_raw", "txn"),
        ("silver/transfers_to", "xfer"),
        ("silver/party", "person"),
        ("silver/account", "acct"),
        ("silver/finding", "finding"),
        ("gold/finding", "g_finding"),
        ("gold/finding_entity", "g_entity"),
        ("gold/finding_edge", "g_edge"),
    ]
    account = "entity_type = 'Account'"
    prefix = "CASE entity_type WHEN 'Account' THEN 'acc:' WHEN 'Party' THEN 'party:' ELSE 'bank:' END"
    return {
        "bronze_transactions": (
            "txn",
            "SELECT * REPLACE (event_timestamp::VARCHAR AS event_timestamp, amount_received::DOUBLE AS amount_received, "
            "amount_paid::DOUBLE AS amount_paid, is_laundering::BIGINT AS is_laundering) FROM txn",
        ),
        "bronze_accounts": ("ledger", "SELECT * FROM ledger"),
        "layer_row_counts": (f"txn xfer person acct finding {gold}", _counts(layers)),
        "assessment_config_upsert": ("finding", _config_sql()),
        "kg_financial_institution": ("bank", "SELECT * FROM bank"),
        "kg_account": ("acct", "SELECT *, CAST(NULL AS VARCHAR) AS currency FROM acct"),
        "kg_party": (
            "person",
            "SELECT party_id, party_id AS source_customer_id, record_source, name, "
            + ", ".join(
                f"CAST(NULL AS VARCHAR) AS {c}"
                for c in ("date_of_birth", "country_of_residence", "address_text", "phone", "email", "government_id", "risk_tier")
            )
            + " FROM person",
        ),
        "kg_txn_ids": (
            "xfer",
            "SELECT id AS fin_txn_id, ts::VARCHAR AS event_timestamp, amt::DOUBLE AS amount_paid, src AS from_account_key, "
            "dst AS to_account_key, lab::BIGINT AS is_laundering FROM xfer",
        ),
        "kg_financial_transaction": (
            "xfer",
            "SELECT id AS fin_txn_id, ts::VARCHAR AS event_timestamp, amt::DOUBLE AS amount_paid, ccy AS payment_currency, "
            "amount_received::DOUBLE AS amount_received, receiving_currency, pf AS payment_format, "
            f"'{K.TRANSACTIONS_SOURCE}' AS source FROM xfer",
        ),
        "kg_has_originating_account": ("xfer", "SELECT id AS fin_txn_id, src AS account_key FROM xfer"),
        "kg_has_beneficiary_account": ("xfer", "SELECT id AS fin_txn_id, dst AS account_key FROM xfer"),
        "kg_transfers_to": (
            "xfer",
            "SELECT id AS fin_txn_id, src AS from_account_key, dst AS to_account_key, ts::VARCHAR AS event_timestamp, "
            "amt::DOUBLE AS amount, ccy AS currency, pf AS payment_format FROM xfer",
        ),
        "kg_has_account": ("owns", "SELECT party_id, account_key, CAST(NULL AS VARCHAR) AS relationship, source FROM owns"),
        "kg_is_held_at": ("acct", "SELECT account_key, bank_id AS fse_id FROM acct"),
        "two_hop_path_counts": (
            "xfer",
            "SELECT account_key, currency, arrivals, departures, paths::DOUBLE AS paths, returning_paths::DOUBLE AS returning_paths, "
            "(paths - returning_paths)::DOUBLE AS open_paths FROM "
            "(SELECT y.src AS account_key, y.ccy AS currency, count(*) AS paths, count(*) FILTER (x.src = y.dst) AS returning_paths "
            "FROM xfer x JOIN xfer y ON y.src = x.dst AND y.ccy = x.ccy AND y.ts BETWEEN x.ts AND x.ts + INTERVAL 14 DAY "
            "WHERE x.amt > 1000 AND y.amt > 1000 AND x.src <> x.dst AND y.src <> y.dst GROUP BY ALL) p "
            "JOIN (SELECT dst AS account_key, ccy AS currency, count(*) AS arrivals FROM xfer WHERE amt > 1000 AND src <> dst GROUP BY ALL) i "
            "USING (account_key, currency) "
            "JOIN (SELECT src AS account_key, ccy AS currency, count(*) AS departures FROM xfer WHERE amt > 1000 AND src <> dst GROUP BY ALL) o "
            "USING (account_key, currency)",
        ),
        "closable_paths": (
            "ring",
            "SELECT i1 AS hop1_id, i2 AS hop2_id, a AS acct_a, b AS acct_b, c AS acct_c, ccy AS currency, t1::VARCHAR AS ts_hop1, "
            "t2::VARCHAR AS ts_hop2, count(*) AS closing_transfers FROM ring GROUP BY ALL",
        ),
        "circular_flow_cycles": (
            "ring",
            "SELECT finding_id, i1 AS hop1_id, i2 AS hop2_id, i3 AS hop3_id, a AS acct_a, b AS acct_b, c AS acct_c, "
            "t1::VARCHAR AS ts_hop1, t2::VARCHAR AS ts_hop2, t3::VARCHAR AS ts_hop3, m1::DOUBLE AS amt_hop1, m2::DOUBLE AS amt_hop2, "
            "m3::DOUBLE AS amt_hop3, ccy AS currency, p1 AS pf_hop1, p2 AS pf_hop2, p3 AS pf_hop3, lo::DOUBLE AS amt_min, "
            "hi::DOUBLE AS amt_max FROM ring",
        ),
        "circular_flow_appended": (
            "ring",
            "SELECT load, row_number() OVER (ORDER BY load, t1, i1, i2, i3) AS finding_id, i1 AS hop1_id, i2 AS hop2_id, i3 AS hop3_id, "
            "a AS acct_a, b AS acct_b, c AS acct_c, t1::VARCHAR AS ts_hop1, t2::VARCHAR AS ts_hop2, t3::VARCHAR AS ts_hop3, "
            "m1::DOUBLE AS amt_hop1, m2::DOUBLE AS amt_hop2, m3::DOUBLE AS amt_hop3, ccy AS currency, p1 AS pf_hop1, p2 AS pf_hop2, "
            "p3 AS pf_hop3, lo::DOUBLE AS amt_min, hi::DOUBLE AS amt_max "
            f"FROM (SELECT *, CASE WHEN t3 >= TIMESTAMP '{SECOND_LOAD}' THEN 2 ELSE 1 END::BIGINT AS load FROM ring) r",
        ),
        "circular_flow_findings": ("ring_finding", _finding_sql("ring_finding")),
        "circular_flow_entities": ("ring_entity", f"SELECT {_ENTITY} FROM ring_entity"),
        "circular_flow_edges": ("ring_edge", f"SELECT {_EDGE} FROM ring_edge"),
        "finding_breakdown": (
            "finding",
            "SELECT finding_type, severity, count(*) AS findings FROM finding GROUP BY ALL",
        ),
        "account_out_degree": ("out_degree", _degree_sql("out")),
        "account_in_degree": ("in_degree", _degree_sql("in")),
        "mule_hub_candidates": (
            "hub",
            "SELECT finding_id, account_key, in_deg, out_deg, in_cnt, out_cnt, in_total::DOUBLE AS in_total, out_total::DOUBLE AS out_total, "
            "t_first::VARCHAR AS ts_first, t_last::VARCHAR AS ts_last, lo::DOUBLE AS amt_min, hi::DOUBLE AS amt_max, ccy AS currency FROM hub",
        ),
        "dominant_currency": ("hub", "SELECT account_key, ccy AS currency FROM hub"),
        "finding_id_offsets": (
            "finding",
            "SELECT assessment_id, min(finding_id) AS first_id, max(finding_id) AS last_id, count(*) AS findings, "
            "min(finding_id) - 1 AS id_offset FROM finding GROUP BY assessment_id",
        ),
        "mule_hub_findings": ("hub_finding", _finding_sql("hub_finding")),
        "mule_hub_top_counterparties": ("hub_cpty", f"SELECT {_CPTY} FROM hub_cpty"),
        "mule_hub_entities": ("hub_entity", f"SELECT {_ENTITY} FROM hub_entity"),
        "mule_hub_edges": ("hub_edge", f"SELECT {_EDGE}, direction FROM hub_edge"),
        "labeled_edges": (
            "marked",
            "SELECT id AS fin_txn_id, src AS from_account_key, dst AS to_account_key, ts::VARCHAR AS event_timestamp, amt::DOUBLE AS amount, "
            "ccy AS currency, pf AS payment_format, count(*) AS copies FROM marked GROUP BY ALL",
        ),
        "exposure_candidates": (
            "exposed",
            "SELECT finding_id, account_key, edges AS labeled_edges, txns AS distinct_labeled_txns, total::DOUBLE AS labeled_amount_total, "
            "lo::DOUBLE AS amt_min, hi::DOUBLE AS amt_max, t_first::VARCHAR AS ts_first, t_last::VARCHAR AS ts_last, ccy AS currency FROM exposed",
        ),
        "exposure_findings": ("exposed_finding", _finding_sql("exposed_finding")),
        "exposure_top_counterparties": ("exposed_cpty", f"SELECT {_CPTY} FROM exposed_cpty"),
        "exposure_entities": ("exposed_entity", f"SELECT {_ENTITY} FROM exposed_entity"),
        "exposure_edges": ("exposed_edge", f"SELECT {_EDGE}, direction, 1::BIGINT AS is_laundering FROM exposed_edge"),
        "gold_finding": ("g_finding", "SELECT * FROM g_finding"),
        "gold_finding_entity": ("g_entity", "SELECT * FROM g_entity"),
        "gold_account_owner": ("owner", "SELECT * FROM owner"),
        "gold_finding_edge": ("g_edge", "SELECT * FROM g_edge"),
        "list_findings": ("g_finding", f"SELECT {_SUMMARY} FROM g_finding {_LIST_ORDER} LIMIT 50"),
        "list_findings_by_severity": (
            "g_finding",
            f"SELECT {_SUMMARY} FROM g_finding WHERE severity = 'HIGH' {_LIST_ORDER} LIMIT {reads.MAX_LIMIT}",
        ),
        "finding_detail": ("g_finding", f"SELECT {_DETAIL} FROM g_finding WHERE finding_id = 1"),
        "finding_graph_entities": ("g_entity", "SELECT * EXCLUDE (finding_id) FROM g_entity WHERE finding_id = 1"),
        "finding_graph_edges": ("g_edge", "SELECT * EXCLUDE (finding_id) FROM g_edge WHERE finding_id = 1"),
        "findings_by_type_sample": (
            "finding",
            "SELECT finding_type, string_agg(finding_id, '|' ORDER BY finding_id) AS ids FROM "
            "(SELECT finding_type, finding_id FROM finding QUALIFY row_number() OVER (PARTITION BY finding_type ORDER BY finding_id) <= 3) s "
            "GROUP BY finding_type",
        ),
        "graph_export_nodes": (
            "g_entity",
            f"SELECT finding_id, {prefix}||entity_id AS id, CASE entity_type WHEN 'Account' THEN 'account' WHEN 'Party' THEN 'party' ELSE 'bank' END AS type, "
            f"CASE WHEN {account} THEN coalesce(nullif(split_part(entity_id, ':', 2), ''), entity_id) ELSE coalesce(display_name, entity_id) END AS label, "
            f"CASE WHEN {account} THEN entity_id END AS full_key, CASE WHEN {account} THEN bank_id END AS bank_id, owner_party_id, country, risk_tier FROM g_entity",
        ),
        "graph_export_edges": (
            "g_entity g_edge",
            "SELECT finding_id, 'cycle:'||hop_order AS id, 'acc:'||from_account_key AS source, 'acc:'||to_account_key AS target, 'cycle' AS type, "
            "CASE WHEN amount <> 0 THEN format('{:,}', round(amount)::BIGINT)||' '||coalesce(currency, '') ELSE '' END AS label, hop_order AS hop FROM g_edge "
            f"UNION ALL SELECT finding_id, 'held:'||entity_id, 'acc:'||entity_id, 'bank:'||bank_id, 'heldAt', NULL, NULL FROM g_entity WHERE {account} AND bank_id IS NOT NULL "
            f"UNION ALL SELECT finding_id, 'owns:'||owner_party_id||'-'||entity_id, 'party:'||owner_party_id, 'acc:'||entity_id, 'hasAccount', NULL, NULL "
            f"FROM g_entity WHERE {account} AND owner_party_id IS NOT NULL",
        ),
        "finding_display": (
            "g_finding",
            f"SELECT finding_id, currency, {_map_case('currency', K.CURRENCY_CODES, "coalesce(currency, '')")} AS currency_code, "
            "countries AS country_names, time_span_hours, "
            f"CASE WHEN time_span_hours IS NULL THEN '{K.MISSING_TEXT}' WHEN time_span_hours < 48 THEN time_span_hours||'h' "
            "ELSE CAST(floor(time_span_hours / 24 + 0.5) AS BIGINT)||'d' END AS duration FROM g_finding",
        ),
        "dq_not_null": (f"txn ledger xfer bank acct person owns finding entity edge {gold}", _not_null_sql()),
        "dq_pk_violations": (f"xfer bank acct person owns finding entity edge {gold}", _pk_sql()),
        "dq_fk_violations": (f"xfer bank acct person owns finding entity edge {gold}", _fk_sql()),
        "dq_findings_without_account": (
            "finding entity",
            "SELECT finding_id FROM finding f WHERE NOT EXISTS (FROM entity e WHERE e.finding_id = f.finding_id AND e.entity_type = 'Account')",
        ),
        "dq_unknown_finding_types": (
            "finding",
            f"SELECT DISTINCT finding_type FROM finding WHERE finding_type NOT IN ({', '.join(map(_text, K.FINDING_TYPES.values()))})",
        ),
        "dq_gold_matches_silver": (
            "finding g_finding",
            "SELECT (SELECT count(*) FROM finding) AS silver_findings, (SELECT count(*) FROM g_finding) AS gold_findings, "
            "(SELECT count(*) FROM finding) = (SELECT count(*) FROM g_finding) AS matches",
        ),
        "dq_label_lineage": (f"txn xfer bank acct person owns finding entity edge {gold}", _lineage_sql()),
        "dq_label_isolation": (
            "xfer bank acct person owns",
            f"SELECT *, CASE table_name WHEN 'label/txn_label' THEN 1 ELSE 0 END::BIGINT AS label_columns FROM ({_counts(_GRAPH_COUNTS)}) c",
        ),
        "eval_base_rate": (
            "xfer",
            "SELECT count(*) AS transactions, count(*) FILTER (lab = 1) AS labeled, count(*) FILTER (lab = 1) / count(*) AS base_rate FROM xfer",
        ),
        "eval_precision": (
            "flag",
            "SELECT detector, count(*) AS flagged_txns, count(*) FILTER (lab = 1) AS labeled_txns, "
            "round(100.0::DOUBLE * count(*) FILTER (lab = 1) / count(*), 1) AS precision_pct FROM flag GROUP BY detector",
        ),
        "eval_recall": (
            "flag xfer",
            "SELECT d.detector, count(DISTINCT id) AS labeled_captured, (SELECT count(*) FROM xfer WHERE lab = 1) AS labeled_total, "
            "round(100.0::DOUBLE * count(DISTINCT id) / (SELECT count(*) FROM xfer WHERE lab = 1), 2) AS recall_pct FROM "
            "(VALUES ('circular_flow'), ('mule_hub'), ('laundering_exposure'), ('graph_native')) d(detector) LEFT JOIN "
            "(SELECT * FROM flag UNION ALL SELECT id, 'graph_native', lab FROM flag WHERE detector IN ('circular_flow', 'mule_hub')) f "
            "ON f.detector = d.detector AND lab = 1 GROUP BY d.detector",
        ),
        "eval_lift": (
            "flag xfer",
            "SELECT detector, round(count(*) FILTER (lab = 1) / count(*) * (SELECT count(*) FROM xfer) / (SELECT count(*) FROM xfer WHERE lab = 1), 2) AS lift "
            "FROM flag GROUP BY detector",
        ),
        "eval_ring_overlap": (
            "ring_edge xfer",
            "SELECT count(*) AS rings, count(*) FILTER (labeled = hops) AS strict_all_labeled, count(*) FILTER (labeled >= 1) AS loose_any_labeled, "
            "coalesce(sum(hops), 0)::BIGINT AS ring_hops, coalesce(sum(labeled), 0)::BIGINT AS labeled_hops FROM "
            "(SELECT finding_id, count(*) AS hops, count(*) FILTER (lab = 1) AS labeled FROM ring_edge JOIN xfer USING (id) GROUP BY finding_id) r",
        ),
        "eval_mule_accounts": (
            "hub_entity xfer",
            "SELECT count(*) AS accounts, count(*) FILTER (labeled >= 1) AS touching_1, count(*) FILTER (labeled >= 5) AS touching_5, "
            "round(avg(labeled / touched), 6) AS mean_labeled_ratio FROM "
            "(SELECT entity_id, count(*) AS touched, count(*) FILTER (lab = 1) AS labeled FROM (SELECT DISTINCT entity_id FROM hub_entity "
            "WHERE entity_type = 'Account') e JOIN (SELECT src AS k, id, lab FROM xfer UNION SELECT dst, id, lab FROM xfer) t ON t.k = e.entity_id "
            "GROUP BY entity_id) a",
        ),
    }


def _rings_sql(hops: int) -> str:
    """Rings of so many hops by a recursive walk, hop by hop from the first."""
    accounts = [f"acct_{c}" for c in "abcdefgh"[:hops]]
    params = rings_of(hops).params
    days, ratio = params["max_time_span_days"], params["max_amount_ratio"]

    def each(field: str, name: str, kind: str) -> str:
        return ", ".join(f"{field}[{k}]{kind} AS {name}{k}" for k in range(1, hops + 1))

    order = ", ".join(["times[1]", *[f"ids[{k}]" for k in range(1, hops + 1)]])
    return f"""
, hop AS (SELECT * FROM xfer WHERE amt > 1000 AND src <> dst),
walk AS (
  SELECT [id] AS ids, [src] AS nodes, dst AS here, ccy, [ts] AS times, [amt] AS amounts, [pf] AS formats, amt AS lo, amt AS hi FROM hop
  UNION ALL
  SELECT list_append(ids, id), list_append(nodes, src), dst, walk.ccy, list_append(times, ts), list_append(amounts, amt),
    list_append(formats, pf), least(lo, amt), greatest(hi, amt)
  FROM walk JOIN hop ON hop.src = walk.here AND hop.ccy = walk.ccy AND hop.ts BETWEEN times[-1] AND times[1] + INTERVAL {days} DAY
    AND greatest(hi, amt) <= {ratio} * least(lo, amt)
  WHERE len(ids) < {hops} AND NOT list_contains(nodes, walk.here) AND (len(ids) < {hops - 1} OR hop.dst = nodes[1])),
found AS (
  SELECT *, row_number() OVER (ORDER BY {order}) AS finding_id, array_to_string(nodes, ' -> ')||' -> '||nodes[1] AS route
  FROM walk WHERE len(ids) = {hops} AND here = nodes[1])
SELECT finding_id, {", ".join(f"ids[{k}] AS hop{k}_id" for k in range(1, hops + 1))}, {", ".join(f"nodes[{k}] AS {a}" for k, a in enumerate(accounts, 1))},
  {each("times", "ts_hop", "::VARCHAR")}, {each("amounts", "amt_hop", "::DOUBLE")}, ccy AS currency, {each("formats", "pf_hop", "")},
  lo::DOUBLE AS amt_min, hi::DOUBLE AS amt_max,
  CASE WHEN len(list_distinct(formats)) = 1 AND hi <= 1.2 * lo THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
  '{hops}-hop circular fund flow: '||route AS title,
  'Ring of {hops} distinct accounts returning funds to origin over '||{_hours("times[1]", f"times[{hops}]")}
    ||' hours. Amount range '||lo::VARCHAR||'-'||hi::VARCHAR||' '||ccy||'.' AS description
FROM found
"""


def _lineage_sql() -> str:
    """Rows of every table, and what each may owe to the label: only the labelled exposure, with what is
    published of it, is chosen by it, and nothing is ordered by it."""
    layers = [("bronze/transactions_raw", "txn"), *_GRAPH_COUNTS]
    layers += [("gold/finding", "g_finding"), ("gold/finding_entity", "g_entity"), ("gold/finding_edge", "g_edge")]
    found = [
        (f"silver/{table}/assessment_id={a}", f"(FROM {step} WHERE assessment_id = '{a}')")
        for table, step in (("finding", "finding"), ("finding_entity", "entity"), ("finding_edge", "edge"))
        for a in ASSESSMENTS
    ]
    return (
        "SELECT *, CASE WHEN table_name IN ('bronze/transactions_raw', 'label/txn_label') THEN 'is_laundering' ELSE '' END AS label_columns, "
        f"table_name LIKE 'gold/%' OR table_name LIKE '%={K.LAUNDERING_EXPOSURE}' AS label_chose, false AS label_ordered "
        f"FROM ({_counts(layers + found)}) c"
    )


def _with_steps(names: list[str]) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for needed in STEPS[name][0]:
                visit(needed)
            ordered.append(name)

    for name in names:
        visit(name)
    return ",\n".join(f"{name} AS MATERIALIZED (\n{STEPS[name][1]}\n)" for name in ordered)


def oracle_sql() -> dict[str, str]:
    plain = {name: f"WITH {_with_steps(steps.split())}\n{select}" for name, (steps, select) in _statements().items()}
    return plain | {f"circular_flow_{n}_hops": f"WITH RECURSIVE {_with_steps(['xfer'])}{_rings_sql(n)}" for n in OTHER_RINGS}
