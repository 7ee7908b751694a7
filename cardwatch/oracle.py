"""DuckDB SQL for every catalog query, written directly against the driver
tables (customer, supplier, nation, events).  Used by the driver's
correctness check and by the tests; it shares no code with the Spark side
beyond the fixed scenario values."""

from __future__ import annotations

RUN = "TIMESTAMP '2024-01-15 06:00:00'"
DAY = "TIMESTAMP '2024-01-15 00:00:00'"
NEXT_DAY = "TIMESTAMP '2024-01-16 00:00:00'"
INF = "TIMESTAMP '9999-12-31 00:00:00'"
REPORT = "DATE '2024-01-15'"
FEED = "DATE '2024-01-15'"


def _v(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


ADAPTERS = f"""
b_cards AS (
  SELECT c_custkey AS k, 'C' || {_v('c_custkey')} AS card_num, 'A' || {_v('c_custkey')} AS account_num
  FROM customer),
b_accounts AS (
  SELECT c_custkey AS k, 'A' || {_v('c_custkey')} AS account_num,
         DATE '2024-01-01' + CAST((c_custkey * 7) % 45 AS INTEGER) AS valid_to,
         {_v('c_custkey')} AS client
  FROM customer),
b_clients AS (
  SELECT c_custkey AS k, {_v('c_custkey')} AS client_id, c_name AS last_name,
         c_mktsegment AS first_name,
         CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 'P' || {_v('c_nationkey')} END AS patronymic,
         DATE '1960-01-01' + CAST(c_custkey % 9000 AS INTEGER) AS date_of_birth,
         'PP' || {_v('c_custkey')} AS passport_num,
         DATE '2024-01-01' + CAST(c_custkey % 60 AS INTEGER) AS passport_valid_to,
         '+' || {_v('c_custkey + 70000')} AS phone
  FROM customer),
b_terminals AS (
  SELECT s.s_suppkey AS k, 'T' || {_v('s.s_suppkey')} AS terminal_id,
         CASE WHEN s.s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type,
         n.n_name AS terminal_city, s.s_name AS terminal_address
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey),
stg_cards AS (
  SELECT card_num, account_num, TIMESTAMP '2023-01-01 00:00:00' AS create_dt,
         CASE WHEN k % 5 = 0 THEN TIMESTAMP '2024-01-14 00:00:00' END AS update_dt
  FROM b_cards WHERE k % 17 <> 0),
stg_accounts AS (
  SELECT account_num, valid_to, client, TIMESTAMP '2023-01-01 00:00:00' AS create_dt,
         CASE WHEN k % 5 = 0 THEN TIMESTAMP '2024-01-14 00:00:00' END AS update_dt
  FROM b_accounts WHERE k % 17 <> 0),
stg_clients AS (
  SELECT client_id, last_name, first_name, patronymic, date_of_birth, passport_num,
         passport_valid_to, phone, TIMESTAMP '2023-01-01 00:00:00' AS create_dt,
         CASE WHEN k % 5 = 0 THEN TIMESTAMP '2024-01-14 00:00:00' END AS update_dt
  FROM b_clients WHERE k % 17 <> 0),
stg_terminals AS (
  SELECT terminal_id, terminal_type, terminal_city, terminal_address, {FEED} AS update_dt
  FROM b_terminals WHERE k % 17 <> 0),
hist_cards AS (
  SELECT card_num, CASE WHEN k % 5 = 0 THEN 'B' || {_v('k')} ELSE account_num END AS account_num,
         TIMESTAMP '2023-01-01 00:00:00' AS start_dt, {INF} AS end_dt,
         CASE WHEN k % 19 = 0 THEN 'Y' ELSE 'N' END AS deleted_flg
  FROM b_cards WHERE k % 11 <> 0
  UNION ALL
  SELECT card_num, 'Z' || {_v('k')}, TIMESTAMP '2022-01-01 00:00:00',
         TIMESTAMP '2022-12-31 23:59:59', 'N'
  FROM b_cards WHERE k % 11 <> 0 AND k % 7 = 0),
hist_accounts AS (
  SELECT account_num,
         CASE WHEN k % 5 = 0 THEN DATE '2023-12-01' + CAST((k * 7) % 45 AS INTEGER)
              ELSE valid_to END AS valid_to, client,
         TIMESTAMP '2023-01-01 00:00:00' AS start_dt, {INF} AS end_dt,
         CASE WHEN k % 19 = 0 THEN 'Y' ELSE 'N' END AS deleted_flg
  FROM b_accounts WHERE k % 11 <> 0
  UNION ALL
  SELECT account_num, DATE '2022-06-30', client, TIMESTAMP '2022-01-01 00:00:00',
         TIMESTAMP '2022-12-31 23:59:59', 'N'
  FROM b_accounts WHERE k % 11 <> 0 AND k % 7 = 0),
hist_clients AS (
  SELECT client_id, last_name, first_name, patronymic, date_of_birth, passport_num,
         passport_valid_to,
         CASE WHEN k % 5 = 0 THEN '+' || {_v('k + 60000')} ELSE phone END AS phone,
         TIMESTAMP '2023-01-01 00:00:00' AS start_dt, {INF} AS end_dt,
         CASE WHEN k % 19 = 0 THEN 'Y' ELSE 'N' END AS deleted_flg
  FROM b_clients WHERE k % 11 <> 0
  UNION ALL
  SELECT client_id, last_name, first_name, patronymic, date_of_birth, passport_num,
         passport_valid_to, '+' || {_v('k + 50000')}, TIMESTAMP '2022-01-01 00:00:00',
         TIMESTAMP '2022-12-31 23:59:59', 'N'
  FROM b_clients WHERE k % 11 <> 0 AND k % 7 = 0),
hist_terminals AS (
  SELECT terminal_id, terminal_type, terminal_city,
         CASE WHEN k % 5 = 0 THEN terminal_address || ' old' ELSE terminal_address END
           AS terminal_address,
         TIMESTAMP '2023-01-01 00:00:00' AS start_dt, {INF} AS end_dt,
         CASE WHEN k % 19 = 0 THEN 'Y' ELSE 'N' END AS deleted_flg,
         TIMESTAMP '2023-01-01 06:00:00' AS processed_dt
  FROM b_terminals WHERE k % 11 <> 0
  UNION ALL
  SELECT terminal_id, terminal_type, terminal_city, terminal_address || ' older',
         TIMESTAMP '2022-01-01 00:00:00', TIMESTAMP '2022-12-31 23:59:59', 'N',
         TIMESTAMP '2023-01-01 06:00:00'
  FROM b_terminals WHERE k % 11 <> 0 AND k % 7 = 0),
fact AS (
  SELECT {_v('event_id')} AS trans_id, CAST(ts AS TIMESTAMP) AS trans_date,
         CAST(value AS DECIMAL(10,2)) AS amt,
         'C' || {_v('user_id')} || ' ' AS card_num, event_type AS oper_type,
         CASE WHEN event_type = 'error' THEN 'REJECT' ELSE 'SUCCESS' END AS oper_result,
         'T' || {_v('event_id % (SELECT count(*) FROM supplier)')} AS terminal,
         CASE WHEN CAST(ts AS DATE) + (CASE WHEN event_id % 7 = 3 THEN 1 ELSE 0 END) IN (DATE '2024-01-13', DATE '2024-01-14')
              THEN DATE '2024-01-15'
              ELSE CAST(ts AS DATE) + (CASE WHEN event_id % 7 = 3 THEN 1 ELSE 0 END) END AS feed_dt
  FROM events),
blacklist_f AS (
  SELECT DATE '2024-01-01' AS enty_dt, 'PP' || {_v('c_custkey')} AS passport_num
  FROM customer WHERE c_acctbal < 0),
meta_before AS (
  SELECT 'dwh' AS schema_name, 'transactions' AS source_name,
         max(feed_dt) AS max_update_dt FROM fact WHERE feed_dt < {REPORT}
  UNION ALL SELECT 'dwh', 'blacklist', max(enty_dt) FROM blacklist_f
  UNION ALL SELECT 'dwh', 'terminals', max(CAST(start_dt AS DATE)) FROM hist_terminals
  UNION ALL SELECT 'dwh', 'cards', max(CAST(start_dt AS DATE)) FROM hist_cards
  UNION ALL SELECT 'dwh', 'accounts', max(CAST(start_dt AS DATE)) FROM hist_accounts
  UNION ALL SELECT 'dwh', 'clients', max(CAST(start_dt AS DATE)) FROM hist_clients)"""

DIMS = {
    "cards": ("card_num", ["account_num"], False),
    "accounts": ("account_num", ["valid_to", "client"], False),
    "clients": ("client_id", ["last_name", "first_name", "patronymic", "date_of_birth",
                              "passport_num", "passport_valid_to", "phone"], False),
    "terminals": ("terminal_id", ["terminal_type", "terminal_city", "terminal_address"], True),
}


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([ADAPTERS.strip(), *[c for c in ctes if c]]) + "\n"


def _merge_ctes(name: str) -> str:
    key, attrs, feed = DIMS[name]
    dl = f"CAST({FEED} AS TIMESTAMP)" if feed else RUN
    oa = ", ".join(f"o.{a} AS o_{a}" for a in attrs)
    sa = ", ".join(f"s.{a} AS s_{a}" for a in attrs)
    sdates = "s.create_dt AS s_create_dt, s.update_dt AS s_update_dt" if not feed else \
        "NULL AS s_create_dt, NULL AS s_update_dt"
    proc = ", o.processed_dt AS o_processed_dt" if feed else ""
    diff = " OR ".join(f"o_{a} IS DISTINCT FROM s_{a}" for a in attrs)
    eff_raw = dl if feed else "s_update_dt"
    start_new = dl if feed else \
        f"CASE WHEN s_create_dt IS NULL OR s_create_dt > {RUN} THEN {RUN} ELSE s_create_dt END"
    o_cols = ", ".join(f"o_{a}" for a in attrs)
    o_named = ", ".join(f"o_{a} AS {a}" for a in attrs)
    s_cols = ", ".join(f"s_{a}" for a in attrs)
    p_new = f", {RUN}" if feed else ""
    p_old = ", o_processed_dt" if feed else ""
    p_new_named = f", {RUN} AS processed_dt" if feed else ""
    return f"""
o_{name} AS (SELECT * FROM hist_{name} WHERE end_dt = {INF}),
j_{name} AS (
  SELECT COALESCE(o.{key}, s.{key}) AS {key}, {oa}, {sa},
         o.start_dt AS o_start_dt, o.end_dt AS o_end_dt, o.deleted_flg AS o_flag{proc},
         {sdates}, o.{key} IS NOT NULL AS has_o, s.{key} IS NOT NULL AS has_s
  FROM o_{name} o FULL OUTER JOIN stg_{name} s ON o.{key} = s.{key}),
c_{name} AS (
  SELECT *,
    CASE WHEN NOT has_o THEN 'NEW'
         WHEN NOT has_s AND o_flag = 'N' THEN 'DELETED'
         WHEN NOT has_s THEN 'STILL_DELETED'
         WHEN o_flag <> 'N' THEN 'RETURNED'
         WHEN {diff} THEN 'CHANGED' ELSE 'SAME' END AS cls,
    CASE WHEN {eff_raw} IS NULL OR {eff_raw} <= o_start_dt OR {eff_raw} > {RUN} THEN {RUN}
         ELSE {eff_raw} END AS eff,
    {start_new} AS start_new, {dl} AS del_ts
  FROM j_{name}),
m_{name} AS (
  SELECT {key}, {o_named}, o_start_dt AS start_dt,
         CASE WHEN cls = 'CHANGED' THEN eff ELSE del_ts END - INTERVAL 1 SECOND AS end_dt,
         o_flag AS deleted_flg{p_new_named},
         CASE WHEN cls = 'DELETED' THEN 'close_deleted' ELSE 'close_changed' END AS step
  FROM c_{name} WHERE cls IN ('CHANGED', 'DELETED', 'RETURNED')
  UNION ALL
  SELECT {key}, {s_cols},
         CASE WHEN cls = 'NEW' THEN start_new WHEN cls = 'CHANGED' THEN eff ELSE del_ts END,
         {INF}, 'N'{p_new}, CASE WHEN cls = 'CHANGED' THEN 'version' ELSE 'insert' END
  FROM c_{name} WHERE cls IN ('NEW', 'CHANGED', 'RETURNED')
  UNION ALL
  SELECT {key}, {o_cols}, del_ts, {INF}, 'Y'{p_new}, 'tombstone'
  FROM c_{name} WHERE cls = 'DELETED'
  UNION ALL
  SELECT {key}, {o_cols}, o_start_dt, o_end_dt, o_flag{p_old}, 'keep'
  FROM c_{name} WHERE cls IN ('SAME', 'STILL_DELETED'))""".strip()


def _dim_cols(name: str) -> str:
    key, attrs, feed = DIMS[name]
    cols = [key, *attrs, "start_dt", "end_dt", "deleted_flg"] + (["processed_dt"] if feed else [])
    return ", ".join(cols)


def scd2_step(name: str, step: str) -> str:
    return _with(_merge_ctes(name)) + f"SELECT {_dim_cols(name)} FROM m_{name} WHERE step = '{step}'"


def scd2_merge(name: str) -> str:
    cols = _dim_cols(name)
    return (_with(_merge_ctes(name))
            + f"SELECT {cols} FROM hist_{name} WHERE end_dt <> {INF}\n"
            + f"UNION ALL SELECT {cols} FROM m_{name}")


# Open versions after the run, by presence: the staged attributes when the key
# is in today's snapshot, otherwise those of the open version before the run.
def _open_after(name: str) -> str:
    key, attrs, _ = DIMS[name]
    pick = ", ".join(f"CASE WHEN s.{key} IS NOT NULL THEN s.{a} ELSE o.{a} END AS {a}"
                     for a in attrs)
    return f"""oa_{name} AS (
  SELECT COALESCE(s.{key}, o.{key}) AS {key}, {pick}
  FROM (SELECT * FROM hist_{name} WHERE end_dt = {INF}) o
  FULL OUTER JOIN stg_{name} s ON o.{key} = s.{key})"""


CLIENT_INFO = """client_info AS (
  SELECT a.account_num, a.valid_to, a.client,
         c.last_name || ' ' || c.first_name || ' ' || c.patronymic AS fio,
         c.passport_num, c.passport_valid_to, c.phone
  FROM stg_accounts a JOIN stg_clients c ON a.client = c.client_id)"""


def _trans_info(bound: str) -> str:
    return f"""trans_info AS (
  SELECT t.trans_id, t.trans_date, trim(k.card_num) AS card_num, k.account_num
  FROM fact t JOIN stg_cards k ON trim(t.card_num) = trim(k.card_num)
  WHERE t.oper_result = 'SUCCESS' {bound})"""


DELIVERED = f"AND t.feed_dt = {REPORT}"
R1_LITERAL_BOUND = f"AND t.trans_date > {DAY}"


def _rep_select(event_dt: str, event_type: str) -> str:
    return (f"SELECT DISTINCT {event_dt} AS event_dt, ci.passport_num AS passport, ci.fio, "
            f"ci.phone, '{event_type}' AS event_type, {REPORT} AS report_dt")


def report_passport(bound: str = DELIVERED) -> str:
    return (_with(CLIENT_INFO, _trans_info(bound)) + _rep_select("ti.trans_date", "1")
            + "\nFROM client_info ci JOIN trans_info ti ON ci.account_num = ti.account_num\n"
            + "WHERE ci.passport_num IN (SELECT passport_num FROM blacklist_f)\n"
            + "   OR ci.passport_valid_to < ti.trans_date")


def report_contract(bound: str = DELIVERED) -> str:
    return (_with(CLIENT_INFO, _trans_info(bound)) + _rep_select("ti.trans_date", "2")
            + "\nFROM client_info ci JOIN trans_info ti ON ci.account_num = ti.account_num\n"
            + "WHERE ti.trans_date > ci.valid_to")


def _pairs(intended: bool) -> str:
    gap = (f"AND lead_date < trans_date + INTERVAL 1 HOUR AND lead_feed = {REPORT}" if intended
           else "AND lead_date IS NOT NULL")
    return f"""tx AS (
  SELECT f.trans_id, f.trans_date, trim(f.card_num) AS card_num, f.terminal, f.oper_result,
         tm.terminal_id, tm.terminal_city, f.feed_dt
  FROM fact f LEFT JOIN stg_terminals tm ON f.terminal = tm.terminal_id),
led AS (
  SELECT *, lead(trans_id) OVER w AS lead_tran, lead(terminal_city) OVER w AS lead_city,
         lead(trans_date) OVER w AS lead_date, lead(feed_dt) OVER w AS lead_feed
  FROM tx WINDOW w AS (PARTITION BY card_num ORDER BY trans_date, trans_id)),
pairs AS (
  SELECT trans_id, trans_date, card_num, terminal_city, lead_tran, lead_city, lead_date
  FROM led WHERE terminal_city <> lead_city AND oper_result = 'SUCCESS' {gap})"""


def hop_pairs(intended: bool = True) -> str:
    return _with(_pairs(intended)) + "SELECT * FROM pairs"


def _city_hop_body() -> str:
    return f"""SELECT max(p.trans_date) AS event_dt, cl.passport_num AS passport,
       cl.last_name || ' ' || cl.first_name || ' ' || cl.patronymic AS fio, cl.phone,
       '3' AS event_type, {REPORT} AS report_dt
FROM pairs p
LEFT JOIN oa_cards k ON p.card_num = trim(k.card_num)
LEFT JOIN oa_accounts a ON k.account_num = a.account_num
LEFT JOIN oa_clients cl ON a.client = cl.client_id
GROUP BY cl.passport_num, cl.last_name || ' ' || cl.first_name || ' ' || cl.patronymic, cl.phone"""


def city_hop(intended: bool = True) -> str:
    return (_with(_pairs(intended), _open_after("cards"), _open_after("accounts"),
                  _open_after("clients")) + _city_hop_body())


def fraud_all(intended: bool = True) -> str:
    parts = []
    if intended:
        parts.append(f"""r1 AS ({_rep_select('ti.trans_date', '1')}
  FROM client_info ci JOIN trans_info ti ON ci.account_num = ti.account_num
  WHERE ci.passport_num IN (SELECT passport_num FROM blacklist_f)
     OR ci.passport_valid_to < ti.trans_date)""")
    parts.append(f"""r2 AS ({_rep_select('ti.trans_date', '2')}
  FROM client_info ci JOIN trans_info ti ON ci.account_num = ti.account_num
  WHERE ti.trans_date > ci.valid_to)""")
    parts.append(f"r3 AS ({_city_hop_body()})")
    body = ("SELECT * FROM r1 UNION ALL " if intended else "") + \
        "SELECT * FROM r2 UNION ALL SELECT * FROM r3"
    return _with(CLIENT_INFO, _trans_info(DELIVERED if intended else ""), _pairs(intended),
                 _open_after("cards"), _open_after("accounts"), _open_after("clients"),
                 *parts) + body


def feed_select(intended: bool = True) -> str:
    order = "file_dt, name" if intended else "name"
    return _with(f"""days AS (SELECT DISTINCT feed_dt AS d FROM fact),
names AS (
  SELECT 'transactions' AS feed, 'transactions_' || strftime(d, '%d%m%Y') || '.txt' AS name,
         d AS file_dt FROM days
  UNION ALL SELECT 'blacklist', 'passport_blacklist_' || strftime(d, '%d%m%Y') || '.xlsx', d
  FROM days
  UNION ALL SELECT 'terminals', 'terminals_' || strftime(d, '%d%m%Y') || '.xlsx', d FROM days),
cand AS (
  SELECT n.*, row_number() OVER (PARTITION BY n.feed ORDER BY {order}) AS rn
  FROM names n JOIN meta_before m ON n.feed = m.source_name
  WHERE n.file_dt > m.max_update_dt)""") + "SELECT feed, name, file_dt FROM cand WHERE rn = 1"


def _snapshot_max() -> str:
    return """maxima AS (
  SELECT 'cards' AS source_name, CAST(max(update_dt) AS DATE) AS max_dt FROM stg_cards
  UNION ALL SELECT 'accounts', CAST(max(update_dt) AS DATE) FROM stg_accounts
  UNION ALL SELECT 'clients', CAST(max(update_dt) AS DATE) FROM stg_clients)"""


def watermark_snapshots(intended: bool = True) -> str:
    if intended:
        return (_with(_snapshot_max())
                + "SELECT m.schema_name, m.source_name, "
                  "COALESCE(x.max_dt, m.max_update_dt) AS max_update_dt\n"
                  "FROM meta_before m LEFT JOIN maxima x ON m.source_name = x.source_name")
    step = "COALESCE((SELECT max_dt FROM maxima WHERE source_name = '{s}'), " \
           "(SELECT max_update_dt FROM {prev} WHERE source_name = '{s}'))"
    w1 = f"w1 AS (SELECT schema_name, source_name, {step.format(s='cards', prev='meta_before')} AS max_update_dt FROM meta_before)"
    w2 = f"w2 AS (SELECT schema_name, source_name, {step.format(s='accounts', prev='w1')} AS max_update_dt FROM w1)"
    w3 = f"w3 AS (SELECT schema_name, source_name, {step.format(s='clients', prev='w2')} AS max_update_dt FROM w2)"
    return _with(_snapshot_max(), w1, w2, w3) + "SELECT * FROM w3"


def scd2_literal(name: str) -> str:
    """The original five statements as a chain of CTEs over the whole history."""
    key, attrs, feed = DIMS[name]
    cols = _dim_cols(name)
    att = ", ".join(attrs)
    s_att = ", ".join(f"s.{a}" for a in attrs)
    diff = lambda x, y, at=attrs: " OR ".join(f"{x}.{a} IS DISTINCT FROM {y}.{a}" for a in at)
    fd = f"CAST({FEED} AS TIMESTAMP)"
    live_open = f"end_dt = {INF} AND deleted_flg = 'N'"
    p_run = f", {RUN}" if feed else ""
    if feed:
        ins1 = f"""ins1 AS (SELECT DISTINCT s.{key}, {s_att}, {fd}, {INF}, 'N'{p_run} FROM stg_{name} s
  WHERE NOT EXISTS (SELECT 1 FROM h0 d WHERE d.{key} = s.{key}))"""
    else:
        cond = live_open if name in ("cards", "clients") else "deleted_flg = 'N'"
        ins1 = f"""ins1 AS (SELECT s.{key}, {s_att}, s.create_dt, {INF}, 'N' FROM stg_{name} s
  WHERE NOT EXISTS (SELECT 1 FROM h0 d WHERE d.{key} = s.{key} AND {cond}))"""
    if name == "cards":
        u1 = f"""tmp2 AS (SELECT s.update_dt AS u FROM stg_cards s
  LEFT JOIN (SELECT * FROM h1 WHERE {live_open}) d ON s.card_num = d.card_num
  WHERE {diff('s', 'd')}),
h2 AS (SELECT card_num, account_num, start_dt,
  CASE WHEN (SELECT count(*) FROM tmp2) > 0 THEN (SELECT max(u) FROM tmp2) - INTERVAL 1 SECOND
       ELSE end_dt END AS end_dt, deleted_flg FROM h1)"""
    elif not feed:
        u1 = f"""tmp2 AS (SELECT s.{key}, max(s.update_dt) AS u FROM stg_{name} s
  JOIN (SELECT * FROM h1 WHERE {live_open}) d ON s.{key} = d.{key}
  WHERE {diff('s', 'd')} GROUP BY s.{key}),
h2 AS (SELECT h1.{key}, {", ".join(f"h1.{a}" for a in attrs)}, h1.start_dt,
  CASE WHEN t.{key} IS NOT NULL THEN t.u - INTERVAL 1 SECOND ELSE h1.end_dt END AS end_dt,
  h1.deleted_flg FROM h1 LEFT JOIN tmp2 t ON h1.{key} = t.{key})"""
    else:
        hit = ("EXISTS (SELECT 1 FROM tmp2 t WHERE t.terminal_id = h1.terminal_id "
               "AND t.terminal_type = h1.terminal_type AND t.terminal_city = h1.terminal_city)")
        u1 = f"""tmp2 AS (SELECT DISTINCT s.terminal_id, s.terminal_type, s.terminal_city
  FROM stg_terminals s LEFT JOIN (SELECT * FROM h1 WHERE {live_open}) d
    ON s.terminal_type = d.terminal_type AND s.terminal_city = d.terminal_city
   AND s.terminal_address = d.terminal_address
  WHERE {diff('s', 'd', [key, *attrs])}),
h2 AS (SELECT terminal_id, {att}, start_dt,
  CASE WHEN {hit} THEN {fd} - INTERVAL 1 SECOND ELSE end_dt END AS end_dt, deleted_flg,
  CASE WHEN {hit} THEN {RUN} ELSE processed_dt END AS processed_dt FROM h1)"""
    if feed:
        v1 = f"""ins3 AS (SELECT DISTINCT d.{key}, {s_att}, {fd}, {INF}, 'N'{p_run}
  FROM stg_{name} s JOIN h2 d ON s.{key} = d.{key} WHERE {diff('s', 'd')})"""
    else:
        v1 = f"""ins3 AS (SELECT DISTINCT s.{key}, {s_att}, s.update_dt, {INF}, 'N'
  FROM stg_{name} s LEFT JOIN (SELECT * FROM h2 WHERE deleted_flg = 'N') d ON s.{key} = d.{key}
  WHERE {diff('s', 'd')})"""
    dl = fd if feed else RUN
    distinct = "DISTINCT " if feed else ""
    gone = f"""gone AS (SELECT DISTINCT d.{key} FROM h3 d WHERE d.end_dt = {INF} AND d.deleted_flg = 'N'
  AND NOT EXISTS (SELECT 1 FROM stg_{name} s WHERE s.{key} = d.{key}))"""
    ins4 = f"""ins4 AS (SELECT {distinct}{key}, {att}, {dl}, {INF}, 'Y'{p_run} FROM h3
  WHERE {live_open} AND {key} IN (SELECT {key} FROM gone))"""
    closing = f"{live_open} AND {key} IN (SELECT {key} FROM gone)"
    h4 = f"""h4 AS (SELECT {key}, {att}, start_dt,
  CASE WHEN {closing} THEN {dl} - INTERVAL 1 SECOND ELSE end_dt END AS end_dt, deleted_flg
  {f", CASE WHEN {closing} THEN {RUN} ELSE processed_dt END AS processed_dt" if feed else ""}
  FROM h3)"""
    return _with(f"h0 AS (SELECT {cols} FROM hist_{name})", ins1,
                 "h1 AS (SELECT * FROM h0 UNION ALL SELECT * FROM ins1)", u1, v1,
                 "h3 AS (SELECT * FROM h2 UNION ALL SELECT * FROM ins3)", gone, ins4, h4) + \
        "SELECT * FROM h4 UNION ALL SELECT * FROM ins4"


def hop_base() -> str:
    """Every transaction with the versions that hold at its time, by a join on the interval itself."""
    after = [f"after_{n} AS ({scd2_merge(n)})" for n in ("cards", "accounts", "clients")]
    at = "led.trans_date >= {d}.start_dt AND led.trans_date < {d}.end_dt + INTERVAL 1 SECOND"
    return _with(_pairs(False), *after) + f"""SELECT DISTINCT c.client_id, c.last_name || ' ' || c.first_name || ' ' || c.patronymic AS fio, c.passport_num, c.phone,
  led.terminal_id, led.terminal_city, k.card_num AS dim_card_num, k.account_num, a.account_num AS dim_account_num, a.client,
  led.trans_date, led.card_num, led.terminal, led.oper_result, led.trans_id, led.lead_tran, led.lead_city, led.lead_date
FROM led LEFT JOIN after_cards k ON led.card_num = trim(k.card_num) AND {at.format(d='k')}
  LEFT JOIN after_accounts a ON k.account_num = a.account_num AND {at.format(d='a')}
  LEFT JOIN after_clients c ON a.client = c.client_id AND {at.format(d='c')}"""


#: Keys whose queries read snapshots of every key (the others need some keys gone).
WHOLE = {"snapshot_cards", "snapshot_accounts", "snapshot_clients", "feed_terminals", "stage_terminals", "stage_wide_values",
         "keys_cards", "keys_accounts", "keys_clients", "keys_terminals", "report_client_info", "report_trans_info",
         "report_passport", "report_passport_prefilter", "report_passport_literal", "report_contract", "report_contract_literal", "report_hop_pairs",
         "report_hop_pairs_literal", "report_hop_base", "report_hop_pairs_stored", "report_append_mart", "join_inner", "join_trimmed_key", "join_left",
         "join_existence", "join_multi_key", "filter_null_safe_diff", "agg_max_update", "sort_report", "watermark_advance_snapshots",
         "watermark_advance_snapshots_literal", "watermark_after_literal_run"}


def oracle_sql() -> dict[str, str]:
    q = {
        "snapshot_cards": _with() + "SELECT * FROM stg_cards",
        "snapshot_accounts": _with() + "SELECT * FROM stg_accounts",
        "snapshot_clients": _with() + "SELECT * FROM stg_clients",
        "snapshot_ranges": """WITH v AS (SELECT c_custkey * c_custkey * c_custkey AS split FROM customer),
o AS (SELECT split, row_number() OVER (ORDER BY split) AS rn, count(*) OVER () AS total FROM v),
b AS (SELECT i, (SELECT min(split) FROM o WHERE rn >= total * i / 8.0) AS bound FROM range(1, 8) r(i)),
x AS (SELECT split, (SELECT count(*) FROM b WHERE bound < split) AS range_no FROM v)
SELECT CAST(range_no AS INTEGER) AS range_no, count(*) * 8 <= 2 * sum(count(*)) OVER () AS even, CAST(sum(count(*)) OVER () AS BIGINT) AS n_rows
FROM x GROUP BY range_no""",
        "feed_transactions": _with() + """SELECT trans_id AS transaction_id,
  strftime(trans_date, '%Y-%m-%d %H:%M:%S.%f') AS transaction_date,
  replace(CAST(amt AS VARCHAR), '.', ',') AS amount, card_num, oper_type, oper_result, terminal
FROM fact""",
        "feed_blacklist": _with() + "SELECT CAST(enty_dt AS VARCHAR) AS enty_dt, passport_num FROM blacklist_f",
        "feed_terminals": _with() + "SELECT terminal_id, terminal_type, terminal_city, terminal_address FROM stg_terminals",
        "watermark_read": _with() + "SELECT max_update_dt FROM meta_before WHERE schema_name = 'dwh' AND source_name = 'transactions'",
        "feed_select": feed_select(True),
        "feed_select_literal": feed_select(False),
        "stage_transactions": _with() + "SELECT trans_id, date_trunc('second', trans_date + INTERVAL 500000 MICROSECOND) AS trans_date, amt, trim(card_num) AS card_num, oper_type, oper_result, terminal FROM fact",
        "stage_terminals": _with() + "SELECT * FROM stg_terminals",
        "stage_blacklist": _with() + "SELECT * FROM blacklist_f",
        "keys_cards": _with() + "SELECT card_num FROM stg_cards",
        "keys_accounts": _with() + "SELECT account_num FROM stg_accounts",
        "keys_clients": _with() + "SELECT client_id FROM stg_clients",
        "keys_terminals": _with() + "SELECT terminal_id FROM stg_terminals",
        "fact_transactions_append": _with() + "SELECT * FROM fact",
        "fact_append_existing": _with() + f"SELECT * FROM fact WHERE feed_dt <= {REPORT}",
        "stage_wide_values": _with() + "SELECT * REPLACE (last_name || repeat('x', 40) AS last_name, phone || ' extension 12345' AS phone) FROM stg_clients",
        "watermark_after_literal_run": f"SELECT schema_name, source_name, CASE WHEN source_name IN ('transactions', 'terminals') THEN {FEED} ELSE max_update_dt END AS max_update_dt FROM ({watermark_snapshots(False)})",
        "fact_blacklist_refresh": _with() + "SELECT * FROM blacklist_f",
        "feed_entries": _with("days AS (SELECT DISTINCT feed_dt AS d FROM fact)") + """SELECT p || strftime(d, '%d%m%Y') || e AS name, d AS file_dt, true AS folder
FROM days, (VALUES ('transactions_', '.txt'), ('passport_blacklist_', '.xlsx'), ('terminals_', '.xlsx')) f(p, e)""",
        "stage_refresh_rewrite": _with() + "SELECT 'after' AS seen, * FROM stg_cards UNION ALL SELECT 'before', s.* FROM ("
                                 + (_with() + "SELECT * FROM stg_cards").replace("WHERE k % 17 <> 0", "") + ") s",
        "blacklist_refresh_rewrite": _with() + f"""SELECT 'after' AS seen, enty_dt, passport_num FROM blacklist_f
UNION ALL SELECT 'before', {REPORT}, passport_num FROM stg_clients""",
        "watermark_advance_feeds": _with() + f"""SELECT schema_name, source_name,
  CASE WHEN source_name IN ('transactions', 'blacklist', 'terminals') THEN {FEED}
       ELSE max_update_dt END AS max_update_dt FROM meta_before""",
        "watermark_advance_snapshots": watermark_snapshots(True),
        "watermark_advance_snapshots_literal": watermark_snapshots(False),
    }
    for name in DIMS:
        for step in ("insert", "close_changed", "version", "tombstone", "close_deleted"):
            q[f"scd2_{step}_{name}"] = scd2_step(name, step)
        q[f"scd2_merge_{name}"] = scd2_merge(name)
        q[f"scd2_merge_{name}_literal"] = scd2_literal(name)
    for name in ("clients", "terminals"):
        q[f"scd2_merge_{name}_buckets"] = scd2_merge(name)
    key, attrs, _ = DIMS["clients"]
    differs = " OR ".join(f"s.{a} IS DISTINCT FROM o.{a}" for a in attrs)
    q["scd2_classes_digest"] = _with() + f"""SELECT coalesce(s.{key}, o.{key}) AS {key},
  CASE WHEN o.{key} IS NULL THEN 'NEW' WHEN s.{key} IS NULL AND o.deleted_flg = 'N' THEN 'DELETED' WHEN s.{key} IS NULL THEN 'STILL_DELETED'
       WHEN o.deleted_flg <> 'N' THEN 'RETURNED' WHEN {differs} THEN 'CHANGED' ELSE 'SAME' END AS class
FROM (SELECT * FROM hist_clients WHERE end_dt = {INF}) o FULL OUTER JOIN stg_clients s ON o.{key} = s.{key}"""
    q.update({
        "report_client_info": _with(CLIENT_INFO) + "SELECT * FROM client_info",
        "report_trans_info": _with(_trans_info(DELIVERED)) + "SELECT * FROM trans_info",
        "report_passport": report_passport(),
        "report_contract": report_contract(),
        "report_hop_pairs": hop_pairs(True),
        "report_city_hop": city_hop(True),
        "report_fraud_all": fraud_all(True),
        "report_passport_prefilter": report_passport(),
        "report_passport_literal": report_passport(R1_LITERAL_BOUND),
        "report_contract_literal": report_contract(""),
        "report_hop_pairs_literal": hop_pairs(False),
        "report_city_hop_literal": city_hop(False),
        "report_fraud_all_literal": fraud_all(False),
        "join_inner": _with() + """SELECT a.account_num, c.client_id, c.passport_num
FROM stg_accounts a JOIN stg_clients c ON a.client = c.client_id""",
        "join_trimmed_key": _with(_trans_info("")) + "SELECT * FROM trans_info",
        "join_left": _with() + """SELECT f.trans_id, f.terminal, t.terminal_city
FROM fact f LEFT JOIN stg_terminals t ON f.terminal = t.terminal_id""",
        "join_anti": _with() + f"""SELECT s.* FROM stg_cards s
WHERE NOT EXISTS (SELECT 1 FROM hist_cards d WHERE d.card_num = s.card_num
                  AND d.end_dt = {INF} AND d.deleted_flg = 'N')""",
        "join_semi": _with() + f"""SELECT d.* FROM hist_cards d
WHERE d.end_dt = {INF} AND d.deleted_flg = 'N'
  AND d.card_num IN (SELECT x.card_num FROM hist_cards x LEFT JOIN stg_cards s
                     ON x.card_num = s.card_num
                     WHERE s.card_num IS NULL AND x.end_dt = {INF} AND x.deleted_flg = 'N')""",
        "join_existence": _with() + f"""SELECT client_id, passport_num, passport_valid_to FROM stg_clients
WHERE passport_num IN (SELECT passport_num FROM blacklist_f) OR passport_valid_to < {REPORT}""",
        "join_multi_key": _with() + f"""SELECT s.terminal_id AS stg_id, d.terminal_id AS dim_id,
  s.terminal_type, s.terminal_city, s.terminal_address
FROM stg_terminals s JOIN hist_terminals d
  ON s.terminal_type = d.terminal_type AND s.terminal_city = d.terminal_city
 AND s.terminal_address = d.terminal_address
WHERE d.end_dt = {INF} AND d.deleted_flg = 'N'""",
        "filter_success": _with() + "SELECT trans_id, trans_date, oper_type FROM fact WHERE oper_result = 'SUCCESS'",
        "filter_null_safe_diff": _with() + f"""SELECT s.client_id, s.update_dt
FROM stg_clients s JOIN hist_clients d ON s.client_id = d.client_id
WHERE d.end_dt = {INF} AND d.deleted_flg = 'N' AND (
  s.last_name IS DISTINCT FROM d.last_name OR s.first_name IS DISTINCT FROM d.first_name
  OR s.patronymic IS DISTINCT FROM d.patronymic OR s.date_of_birth IS DISTINCT FROM d.date_of_birth
  OR s.passport_num IS DISTINCT FROM d.passport_num
  OR s.passport_valid_to IS DISTINCT FROM d.passport_valid_to OR s.phone IS DISTINCT FROM d.phone)""",
        "distinct_rows": _with() + "SELECT DISTINCT trim(card_num) AS card_num, terminal FROM fact",
        "agg_latest_event": _with() + """SELECT trim(card_num) AS card_num, max(trans_date) AS last_trans_date
FROM fact WHERE oper_result = 'SUCCESS' GROUP BY trim(card_num)""",
        "agg_max_update": _with(_snapshot_max()) + "SELECT * FROM maxima",
        "coalesce_scalar_subquery": _with() + """SELECT source_name, COALESCE(
  (SELECT CAST(max(update_dt) AS DATE) FROM stg_cards),
  (SELECT max_update_dt FROM meta_before WHERE source_name = 'cards')) AS max_update_dt
FROM meta_before WHERE source_name = 'cards'
UNION ALL SELECT source_name, COALESCE(
  (SELECT CAST(max(update_dt) AS DATE) FROM stg_accounts),
  (SELECT max_update_dt FROM meta_before WHERE source_name = 'accounts'))
FROM meta_before WHERE source_name = 'accounts'
UNION ALL SELECT source_name, COALESCE(
  (SELECT CAST(max(update_dt) AS DATE) FROM stg_clients),
  (SELECT max_update_dt FROM meta_before WHERE source_name = 'clients'))
FROM meta_before WHERE source_name = 'clients'""",
        "window_lead": _with() + "SELECT trans_id, trans_date, trim(card_num) AS card_num, lead(trans_id) OVER (PARTITION BY trim(card_num) ORDER BY trans_date, trans_id) AS lead_tran FROM fact",
        "report_hop_base": hop_base(),
        "report_hop_pairs_stored": hop_pairs(True),
        "report_city_hop_stored": city_hop(True),
        "report_append_mart": report_contract(),
        "sort_report": report_passport() + "\nORDER BY fio",
    })
    return {k: v.replace("WHERE k % 17 <> 0", "") if k in WHOLE else v for k, v in q.items()}
