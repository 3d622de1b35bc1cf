"""The registered queries in SQL, written from the definitions rather than from the Spark
plans: windows over whole keys, as-of joins, grids and full joins."""

from __future__ import annotations

from . import store_oracles

# --- calendar and index --------------------------------------------------------------------

HOLIDAYS = """
holidays AS (SELECT DISTINCT DATE '2024-01-01' + CAST(5 * n_nationkey AS INTEGER) AS d FROM nation)"""

INDEX = HOLIDAYS + """,
index_days AS (
  SELECT CAST(ts AS DATE) AS d, 1 + count(*) / CAST(100000 AS DOUBLE) AS value
  FROM events
  WHERE event_type = 'view' AND ts < TIMESTAMP '2024-01-21' AND dayofweek(ts) NOT IN (0, 6)
    AND CAST(ts AS DATE) NOT IN (SELECT d FROM holidays)
  GROUP BY 1),
latest AS (
  SELECT arg_max(value, d) AS value, max(CAST(CAST(d AS TIMESTAMP) - INTERVAL 3 HOUR AS DATE)) AS d
  FROM index_days
  WHERE CAST(CAST(d AS TIMESTAMP) - INTERVAL 3 HOUR AS DATE) <= DATE '2024-01-20' AND value <> 1),
calendar AS (
  SELECT c.d, h.d IS NULL AND dayofweek(c.d) NOT IN (0, 6) AS working
  FROM (SELECT CAST(range AS DATE) AS d
        FROM range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-07', INTERVAL 1 DAY)) c
  LEFT JOIN holidays h ON c.d = h.d),
factors AS (
  SELECT c.d, c.working, c.d > (SELECT d FROM latest) AS forecast,
         CASE WHEN c.d > (SELECT d FROM latest)
              THEN CASE WHEN c.working THEN (SELECT value FROM latest) ELSE 1 END
              ELSE coalesce(i.value, 1) END AS value
  FROM calendar c LEFT JOIN index_days i ON c.d = i.d),
returns AS (
  SELECT * FROM (
    SELECT d, working, forecast, value,
           exp(sum(ln(value)) OVER (ORDER BY d ROWS BETWEEN 7 PRECEDING AND 3 PRECEDING)) AS by_settlement,
           exp(sum(ln(value)) OVER (ORDER BY d ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)) AS by_due
    FROM factors)
  WHERE d >= DATE '2024-01-08')"""

# --- purchases -----------------------------------------------------------------------------

LOG = """
log AS (
  SELECT CAST(user_id AS VARCHAR) AS id, CAST(event_id AS VARCHAR) AS lid, ts, CAST(ts AS DATE) AS d,
         CASE event_type WHEN 'purchase' THEN 'confirmed' ELSE 'reversed' END AS type,
         CAST(round(value * 100) AS BIGINT) AS amount,
         CASE WHEN event_type = 'purchase' THEN CAST(ts AS DATE) END AS confirmed_on,
         CASE WHEN event_type = 'purchase' THEN ts END AS confirmed_at, CAST(c_nationkey AS VARCHAR) AS issuer
  FROM events JOIN customer ON user_id = c_custkey
  WHERE event_type IN ('purchase', 'error') AND NOT value < 5 AND NOT value > 200 AND c_nationkey <> 0
    AND CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-30')"""

CYCLES = LOG + """,
attributed AS (
  SELECT *, id || CAST(cycle AS VARCHAR) AS internal, type = 'reversed' AND coalesce(d < cycle + 7, FALSE) AS early
  FROM (SELECT *, max(CASE WHEN type = 'confirmed' THEN d END) OVER (
          PARTITION BY id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cycle
        FROM log)),
amounts AS (
  SELECT internal AS "internalId", id AS "endToEndId", CAST(cycle AS VARCHAR) AS "confirmationDate",
         strftime(min(ts) FILTER (type = 'confirmed'), '%Y-%m-%d %H:%M:%S.%f') AS "firstConfirmed",
         CAST(cycle + 5 AS VARCHAR) AS "dueDate", CAST(cycle + 7 AS VARCHAR) AS "settlementDate",
         CAST(sum(amount) FILTER (type = 'confirmed') AS BIGINT) AS "confirmedAmount",
         CAST(sum(amount) FILTER (early) AS BIGINT) AS "reversedBeforeSettlement",
         CAST(sum(amount) FILTER (type = 'reversed' AND NOT early) AS BIGINT) AS "reversedAfterSettlement"
  FROM attributed WHERE cycle IS NOT NULL GROUP BY internal, id, cycle)"""

PREVIOUS_ROW = LOG + """,
dated AS (SELECT *, coalesce(confirmed_on, d) AS day FROM log),
first_of_id AS (
  SELECT id, arg_min(day, (ts, lid)) AS day, arg_min(confirmed_on, (ts, lid)) AS confirmed_on
  FROM dated WHERE type = 'confirmed' GROUP BY id),
assigned AS (
  SELECT id, type, amount, CASE type WHEN 'confirmed' THEN day ELSE lag(day) OVER (PARTITION BY id ORDER BY day, ts, lid) END AS to_day
  FROM dated),
sums AS (
  SELECT id, to_day, sum(amount) FILTER (type = 'confirmed') AS confirmed, sum(amount) FILTER (type = 'reversed') AS reversed
  FROM assigned GROUP BY id, to_day),
amounts AS (
  SELECT c.id, c.day, CASE WHEN c.day = f.day THEN f.confirmed_on END AS confirmed_on,
         CASE WHEN c.day = f.day THEN c.day + 5 END AS due, CASE WHEN c.day = f.day THEN c.day + 7 END AS settled,
         s.confirmed, CASE WHEN c.day < f.day + 7 THEN s.reversed END AS before,
         CASE WHEN f.day IS NULL OR c.day >= f.day + 7 THEN s.reversed END AS after
  FROM (SELECT DISTINCT id, day FROM dated) c LEFT JOIN first_of_id f USING (id)
    LEFT JOIN sums s ON s.id = c.id AND s.to_day = c.day)"""


def _issuer_daily(time: str, confirmed: str) -> str:
    """Reversals against the first confirmation and its settlement, as instants or as days."""
    return LOG + f""",
dated AS (
  SELECT *, first_value(d IGNORE NULLS) OVER w AS first_day, first_value({time} IGNORE NULLS) OVER w AS first_time,
         first_value({confirmed} IGNORE NULLS) OVER w AS first_confirmed
  FROM (SELECT * REPLACE (CASE WHEN type = 'confirmed' THEN d END AS d), {time} AS compared, d AS own_day,
               CASE WHEN type = 'confirmed' THEN d END AS confirmed_day, type = 'confirmed' AS first_row FROM log)
  WINDOW w AS (PARTITION BY id ORDER BY confirmed_day IS NULL, ts, lid ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
flows AS (
  SELECT CASE WHEN type = 'reversed' AND compared > first_time + INTERVAL 7 DAY THEN own_day ELSE first_day + 5 END AS day, issuer, amount,
         CASE WHEN type = 'confirmed' THEN 'confirmed' WHEN compared > first_time + INTERVAL 7 DAY THEN 'late'
              WHEN compared >= first_confirmed THEN 'early' END AS kind
  FROM dated WHERE first_confirmed IS NOT NULL),
sums AS (
  SELECT day, issuer, sum(amount) FILTER (kind = 'confirmed') AS confirmed, sum(amount) FILTER (kind = 'early') AS early,
         sum(amount) FILTER (kind = 'late') AS late
  FROM flows GROUP BY day, issuer)"""

# --- cards ---------------------------------------------------------------------------------

CARD_LOG = """
card_log AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS card,
         CASE WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM', '5-LOW') THEN 'physical' ELSE 'virtual' END AS card_type,
         CASE l_returnflag WHEN 'N' THEN 'created' WHEN 'R' THEN 'unblocked' ELSE 'canceled' END AS type,
         l_shipdate AS happened, o_orderdate AS created,
         CAST(CAST(o_orderdate AS DATE) + INTERVAL 36 MONTH AS DATE) AS expiration,
         CAST(o_custkey AS VARCHAR) AS holder, CAST(c_nationkey AS VARCHAR) AS issuer
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""

EVENTS = CARD_LOG + """,
expirations AS (
  SELECT * FROM (SELECT card, card_type, expiration, holder, issuer, row_number() OVER (
                   PARTITION BY card ORDER BY created, expiration, card_type, holder, issuer) AS rn
                 FROM card_log) WHERE rn = 1),
first_events AS (
  SELECT * FROM (SELECT card, card_type, type, happened,
                        row_number() OVER (PARTITION BY card, type ORDER BY happened, card_type) AS rn
                 FROM card_log WHERE type IN ('created', 'canceled', 'unblocked')) WHERE rn = 1),
all_events AS (
  SELECT card, card_type, type, happened FROM first_events
  UNION ALL
  SELECT card, card_type, 'expiration', CAST(expiration AS TIMESTAMP) FROM expirations
  WHERE expiration <= DATE '2001-08-01')"""

DELTAS = EVENTS + """,
ordered AS (
  SELECT a.*, e.holder, e.issuer,
         lag(a.type) OVER w AS previous, row_number() OVER w AS number,
         CAST(date_trunc('quarter', a.happened) AS DATE) AS start
  FROM all_events a LEFT JOIN expirations e USING (card)
  WINDOW w AS (PARTITION BY a.card ORDER BY a.happened, CASE a.type WHEN 'created' THEN 1 WHEN 'unblocked' THEN 2
                                              WHEN 'canceled' THEN 3 ELSE 4 END)),
deltas AS (
  SELECT card, card_type, type, holder, issuer, number, n_name AS issuer_name,
         CASE WHEN type IN ('canceled', 'expiration') THEN CAST(start + INTERVAL 3 MONTH AS DATE) ELSE start END AS quarter,
         CASE WHEN type = 'created' AND card_type = 'virtual' THEN 1
              WHEN type = 'unblocked' AND card_type = 'physical' THEN 1
              WHEN type IN ('canceled', 'expiration') AND card_type = 'virtual' THEN -1
              WHEN type IN ('canceled', 'expiration') AND card_type = 'physical' AND previous = 'unblocked' THEN -1
              ELSE 0 END AS delta
  FROM ordered LEFT JOIN nation ON issuer = CAST(n_nationkey AS VARCHAR))"""

HOLDERS = DELTAS + """,
activity AS (SELECT holder, issuer, quarter, sum(delta) AS delta FROM deltas GROUP BY ALL),
balances AS (
  SELECT holder, quarter, max(issuer) AS issuer, sum(sum(delta)) OVER (PARTITION BY holder ORDER BY quarter) AS balance
  FROM activity GROUP BY holder, quarter),
quarters AS (
  SELECT CAST(unnest(generate_series(CAST(min(quarter) AS TIMESTAMP), CAST(max(quarter) AS TIMESTAMP), INTERVAL 3 MONTH)) AS DATE) AS quarter
  FROM activity),
dense AS (
  SELECT g.quarter, g.holder, b.issuer, b.balance
  FROM (SELECT quarter, holder FROM quarters CROSS JOIN (SELECT DISTINCT holder FROM balances)) g
  ASOF JOIN balances b ON g.holder = b.holder AND g.quarter >= b.quarter),
active AS (SELECT quarter, issuer, count(*) AS holders FROM dense WHERE balance > 0 GROUP BY ALL)"""

RECONCILED = DELTAS + """,
collection AS (SELECT DISTINCT card, issuer_name, card_type FROM deltas),
peaks AS (
  SELECT card, quarter, max(balance) AS balance
  FROM (SELECT card, quarter, sum(delta) OVER (PARTITION BY card ORDER BY delta DESC, quarter, number
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS balance
        FROM deltas WHERE quarter <= DATE '2000-01-01')
  GROUP BY card, quarter),
own AS (
  SELECT c.card, c.issuer_name, c.card_type, DATE '2000-01-01' AS quarter, p.balance
  FROM collection c LEFT JOIN (SELECT card, arg_max(balance, quarter) AS balance FROM peaks GROUP BY card) p USING (card)),
own_cards AS (SELECT card, min(card_type) AS card_type, any_value(balance) AS balance FROM own GROUP BY card),
status AS (SELECT CAST(o_orderkey AS VARCHAR) AS card, arg_min(o_orderstatus, (o_orderdate, o_orderstatus)) AS status FROM orders GROUP BY 1),
partner AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS card, 'partner' AS origin FROM orders WHERE o_orderpriority <> '5-LOW'),
listed AS (
  SELECT p.card, p.origin, o.balance, o.card_type, s.status
  FROM (SELECT DISTINCT card, origin FROM partner) p LEFT JOIN own_cards o USING (card) LEFT JOIN status s USING (card)),
missing AS (
  SELECT o.card, CAST(NULL AS VARCHAR) AS origin, o.balance, o.card_type, s.status
  FROM own_cards o LEFT JOIN status s USING (card) WHERE o.balance > 0 AND o.card NOT IN (SELECT card FROM partner)),
divergent AS (
  SELECT * FROM listed WHERE balance <= 0 UNION ALL SELECT * FROM missing)"""

CARD_COLUMNS = """card AS "issuingCardId", origin, CAST(balance AS BIGINT) AS balance, card_type AS "cardType", status"""

HISTORY = RECONCILED + """,
histories AS (
  SELECT v.card, v.origin, v.balance, v.card_type, v.status,
         list(CAST(coalesce(CAST(l.happened AS DATE), DATE '1900-01-01') AS VARCHAR) ORDER BY l.happened, l.type) AS dates,
         list(coalesce(l.type, 'NULL') ORDER BY l.happened, l.type) AS types
  FROM divergent v LEFT JOIN card_log l ON v.card = l.card GROUP BY ALL)"""


def _history_arrays(condition: str) -> str:
    return f"""WITH {HISTORY}
SELECT {CARD_COLUMNS}, array_to_string(dates, ',') AS "eventDates", array_to_string(types, ',') AS events
FROM histories WHERE {condition}"""


def _history(condition: str) -> str:
    return f"""WITH {RECONCILED}
SELECT {CARD_COLUMNS}, CAST(coalesce(sum(n) OVER (PARTITION BY card ORDER BY happened, type
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS position,
       CAST(coalesce(CAST(happened AS DATE), DATE '1900-01-01') AS VARCHAR) AS "eventDate", coalesce(type, 'NULL') AS event, n AS copies
FROM (SELECT v.card, v.origin, v.balance, v.card_type, v.status, l.happened, l.type, count(*) AS n
      FROM divergent v LEFT JOIN card_log l ON v.card = l.card WHERE {condition} GROUP BY ALL)"""


# --- receivables ---------------------------------------------------------------------------

LINES = """
lines AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || strftime(l_shipdate, '-%Y-%m-%d') AS id,
         CAST(l_orderkey AS VARCHAR) AS purchase, l_shipdate AS created,
         l_shipdate + INTERVAL 1 DAY * (30 * l_linenumber) AS due,
         CAST(l_suppkey AS VARCHAR) AS workspace, l_linestatus AS status, l_returnflag, l_quantity,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS amount,
         nullif(CAST(round(l_extendedprice * l_discount * 100) AS BIGINT), 0) AS fee,
         CAST(round(l_extendedprice * l_tax * 100) AS BIGINT) AS external
  FROM lineitem)"""

DUE = LINES + """,
holidays AS (
  SELECT DISTINCT make_date(y, CAST(1 + n_nationkey % 12 AS BIGINT), CAST(1 + n_nationkey AS BIGINT)) AS d
  FROM nation CROSS JOIN range(1995, 2004) years(y)),
days AS (
  SELECT c.d, h.d IS NULL AND dayofweek(c.d) NOT IN (0, 6) AS working
  FROM (SELECT CAST(unnest(generate_series(CAST(min(d) AS TIMESTAMP), CAST(max(d) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM holidays) c
  LEFT JOIN holidays h ON c.d = h.d),
next_days AS (
  SELECT a.d, b.d AS moved FROM days a ASOF JOIN (SELECT d FROM days WHERE working) b ON a.d <= b.d),
merchant_purchases AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS purchase, 'e' || o_orderkey AS e2e,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'credit' WHEN '2-HIGH' THEN 'debit'
                              WHEN '3-MEDIUM' THEN 'prepaid' ELSE 'other' END AS funding,
         CASE WHEN o_orderstatus = 'P' THEN 'voided' ELSE 'confirmed' END AS status
  FROM orders),
acquirer_dues AS (
  SELECT l.id, CAST(l.due - INTERVAL 3 HOUR AS DATE) AS nominal, CAST(l.created - INTERVAL 3 HOUR AS DATE) AS created_on,
         n.moved AS acquirer_due
  FROM lines l LEFT JOIN merchant_purchases p USING (purchase)
    LEFT JOIN next_days n ON n.d = CAST(l.created - INTERVAL 3 HOUR AS DATE)
      + CASE p.funding WHEN 'credit' THEN 31 WHEN 'debit' THEN 2 WHEN 'prepaid' THEN 2 ELSE 31 END)"""

FACT = DUE + """,
acquiring AS (
  SELECT o_orderkey AS acquiring_id, 'e' || o_orderkey AS e2e, CAST(round(o_totalprice * 100) AS BIGINT) AS amount,
         CASE WHEN o_orderstatus = 'P' THEN 'voided'
              WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'denied' ELSE 'confirmed' END AS status
  FROM orders),
acquiring_installments AS (
  SELECT purchase, due, sum(external) AS external FROM lines WHERE l_returnflag <> 'R' GROUP BY ALL),
fact AS (
  SELECT l.id, CAST(l.created - INTERVAL 3 HOUR AS DATE) AS created_on, CAST(l.due - INTERVAL 3 HOUR AS DATE) AS merchant_due,
         o.o_orderpriority AS network, l.workspace, l.status, l.amount, l.fee, a.external,
         l.l_quantity >= 46 AS factoring, p.status AS purchase_status, d.nominal, d.acquirer_due
  FROM lines l JOIN orders o ON l.purchase = CAST(o.o_orderkey AS VARCHAR)
    LEFT JOIN merchant_purchases p USING (purchase)
    LEFT JOIN acquiring q USING (e2e)
    LEFT JOIN acquirer_dues d ON l.id = d.id
    LEFT JOIN acquiring_installments a ON CAST(q.acquiring_id AS VARCHAR) = a.purchase
      AND d.nominal = CAST(a.due - INTERVAL 3 HOUR AS DATE)
    LEFT JOIN supplier w ON l.workspace = CAST(w.s_suppkey AS VARCHAR)
  WHERE CAST(l.created - INTERVAL 3 HOUR AS DATE) BETWEEN DATE '2000-09-04' AND DATE '2001-11-04'
    AND (q.amount > 0 OR q.status = 'voided') AND q.status IN ('confirmed', 'voided')
    AND w.s_nationkey NOT IN (0, 1))"""


def _missing(suffix: str) -> str:
    return f"""
  CAST(sum(CASE WHEN fee IS NULL AND external IS NULL THEN amount END) AS BIGINT) AS "amountWithoutFeeAndExternalFee{suffix}",
  CAST(sum(CASE WHEN fee IS NULL AND external IS NOT NULL THEN amount END) AS BIGINT) AS "amountWithoutFeeOnly{suffix}",
  CAST(sum(CASE WHEN fee IS NOT NULL AND external IS NULL THEN amount END) AS BIGINT) AS "amountWithoutExternalFeeOnly{suffix}\""""


def _unless_voided(column: str) -> str:
    return f"CASE WHEN purchase_status = 'voided' THEN 0 ELSE {column} END"


def _rollup(date: str, measures: str) -> str:
    return f"""SELECT {date} AS ref, network, status, workspace, factoring, {measures}
FROM fact GROUP BY ref, network, status, workspace, factoring"""


CREATED = _rollup("created_on", f"""
  CAST(sum({_unless_voided('amount')}) AS BIGINT) AS "amountCreated",
  CAST(sum({_unless_voided('fee')}) AS BIGINT) AS "feeCreated",
  CAST(NULL AS BIGINT) AS "factoringFeeCreated", CAST(NULL AS BIGINT) AS "externalFactoringFeeCreated",
  CAST(sum(fee - external) AS BIGINT) AS "netResultWithoutFactoringCreated",
  CAST(sum(external) AS BIGINT) AS "externalFeeCreated", {_missing('Created')},
  round(avg(date_diff('day', acquirer_due, nominal)), 6) AS "daysBetweenPaymentsAvgCreated" """)
MERCHANT = _rollup("merchant_due", f"""
  CAST(sum({_unless_voided('amount')} - {_unless_voided('fee')}) AS BIGINT) AS "amountToMerchant",
  {_missing('ToMerchant')}""")
ACQUIRER = _rollup("CASE WHEN factoring THEN merchant_due ELSE acquirer_due END", f"""
  CAST(sum({_unless_voided('amount')} - {_unless_voided('external')}) AS BIGINT) AS "amountFromAcquirer",
  {_missing('FromAcquirer')}""")


def _rollup_query(rollup: str) -> str:
    return f"""WITH {FACT}, rollup_ AS ({rollup})
SELECT CAST(ref AS VARCHAR) AS "referenceDate", network, status AS "installmentStatus", workspace AS "workspaceId",
       factoring AS "isFactoring", * EXCLUDE (ref, network, status, workspace, factoring)
FROM rollup_"""


# --- weekly report -------------------------------------------------------------------------

RECORDS = """
records AS (
  SELECT o.*, c.*, n.*, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL WHEN n_regionkey IN (0, 3) THEN 'USD' ELSE 'BRL' END AS currency,
         CASE WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM', '5-LOW') THEN 'physical' ELSE 'virtual' END AS raw_card_type
  FROM orders o JOIN customer c ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n_nationkey)"""

CONVERTED = RECORDS + """,
calculated AS (
  SELECT *, CAST(floor(cents / 100) AS BIGINT) AS fee, CAST(floor(cents / 200) AS BIGINT) AS merchant_fee,
         CASE WHEN network = 0 THEN 0 ELSE round(cents / network, 4) END AS rate,
         CASE WHEN currency = 'BRL' THEN 0 WHEN confirmed < DATE '1998-01-01' THEN CAST(0.04 AS DOUBLE)
              ELSE CAST(0.02 AS DOUBLE) END AS spread,
         CASE WHEN c_mktsegment = 'BUILDING' THEN confirmed - 1 ELSE confirmed END AS conciliated
  FROM (SELECT *, CAST(o_orderdate AS DATE) + 1 AS confirmed,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 0 ELSE CAST(floor(cents / 5) AS BIGINT) END AS network
        FROM records WHERE o_orderstatus IN ('O', 'P')))"""

# --- settlement reports --------------------------------------------------------------------


def _brazilian(amount: str) -> str:
    return f"translate(format('{{:,.2f}}', {amount}), ',.', '.,')"


REPORT = f"""
sales AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || strftime(l_shipdate, '-%Y-%m-%d') AS id,
         CAST(l_linenumber AS VARCHAR) AS number,
         CASE WHEN l_tax = 0 THEN 'xx' ELSE strftime(l_shipdate, '%d/%m/%Y') END AS sold,
         CASE WHEN l_tax <> 0 THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS sold_iso,
         {_brazilian('l_extendedprice')} AS gross, l_extendedprice,
         {_brazilian('round(l_extendedprice * (1 - l_discount) * 100) / 100')} AS net,
         l_linestatus, l_returnflag
  FROM lineitem)"""

# --- snapshots -----------------------------------------------------------------------------

SNAPSHOTS = """
snapshots AS (
  SELECT event_id, ts AS updated_on, CAST(ts AS DATE) + CAST(floor(hour(ts) / 6) AS INTEGER) AS data,
         CASE event_type WHEN 'purchase' THEN 'realizado' ELSE 'previsto' END AS tipo,
         CAST(round(value * 100) AS BIGINT) AS valor
  FROM events)"""

CAPTURED = SNAPSHOTS + f""",
captured AS (
  SELECT event_id, updated_on, tipo, data - 20 AS day, valor,
         'dia ' || strftime(data - 20, '%d') || '/' ||
           ['Jan', 'Fev', 'Mar', 'Abr', 'Mai', 'Jun', 'Jul', 'Ago', 'Set', 'Out', 'Nov', 'Dez'][CAST(month(data - 20) AS INTEGER)] AS label,
         'R$ ' || {_brazilian('valor / 100')} AS value
  FROM snapshots),
-- as of January 2024 a December label is of the year before, any other one of 2024
labelled AS (
  SELECT *, make_date(CASE WHEN month(day) = 12 THEN 2023 ELSE 2024 END, month(day), day(day)) AS parsed,
         CAST(trunc(CAST(replace(regexp_replace(value, '[^0-9,]', '', 'g'), ',', '.') AS DOUBLE) * 100) AS BIGINT) AS cut
  FROM captured)"""

MERGE = """
merged AS (
  SELECT *, row_number() OVER (PARTITION BY data ORDER BY CASE tipo WHEN 'realizado' THEN 0 ELSE 1 END, updated_on DESC, valor) AS rn
  FROM (SELECT * FROM history WHERE data >= (SELECT min(data) FROM new) UNION ALL SELECT * FROM new))
SELECT strftime(updated_on, '%Y-%m-%d %H:%M:%S.%f') AS updated_on, CAST(data AS VARCHAR) AS data, tipo, valor
FROM history WHERE data < (SELECT min(data) FROM new)
UNION ALL
SELECT strftime(updated_on, '%Y-%m-%d %H:%M:%S.%f'), CAST(data AS VARCHAR), tipo, valor FROM merged WHERE rn = 1"""

def _issuer_daily_remuneration(time: str, confirmed: str) -> str:
    return f"""WITH {INDEX}, {_issuer_daily(time, confirmed)},
joined AS (
  SELECT r.d, i.issuer, n.n_name, r.by_due AS acc, r.value, r.forecast, s.confirmed, s.early, s.late
  FROM returns r CROSS JOIN (SELECT DISTINCT issuer FROM log) i
    JOIN nation n ON i.issuer = CAST(n.n_nationkey AS VARCHAR)
    LEFT JOIN sums s ON s.day = r.d AND s.issuer = i.issuer
  WHERE r.d <= DATE '2024-01-30')
SELECT CAST(d AS VARCHAR) AS "referenceDate", issuer AS "subIssuerTaxId", n_name AS "subIssuerName",
       round(acc, 6) AS "accumulatedReturn", round(value, 6) AS "indexValue", forecast AS "isForecast",
       CAST(coalesce(confirmed, 0) - coalesce(early, 0) AS BIGINT) AS "baseValue",
       CAST(round((coalesce(confirmed * acc - confirmed, 0) - coalesce(early * acc - early, 0)) * CAST(0.6 AS DOUBLE)) AS BIGINT) AS remuneration,
       CAST(coalesce(confirmed, 0) AS BIGINT) AS confirmed,
       CAST(coalesce(early, 0) AS BIGINT) AS "reversedBeforeSettlement",
       CAST(coalesce(late, 0) AS BIGINT) AS "reversedAfterSettlement",
       CAST(round(coalesce(confirmed * acc - confirmed, 0) * CAST(0.6 AS DOUBLE)) AS BIGINT) AS "remunerationConfirmed",
       CAST(round(coalesce(early * acc - early, 0) * CAST(0.6 AS DOUBLE)) AS BIGINT) AS "remunerationReversedBeforeSettlement"
FROM joined"""


ORACLES: dict[str, str] = {
    "working_calendar": f"""WITH {HOLIDAYS},
bounds AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events),
spine AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d FROM bounds)
SELECT CAST(s.d AS VARCHAR) AS "referenceDate", h.d IS NULL AND dayofweek(s.d) NOT IN (0, 6) AS "isWorkingDay",
       count(e.ts) AS events
FROM spine s LEFT JOIN holidays h ON s.d = h.d LEFT JOIN events e ON CAST(e.ts AS DATE) = s.d GROUP BY ALL""",
    "next_business_day": f"""WITH {DUE}
SELECT CAST(n.moved AS VARCHAR) AS "businessDay", count(*) AS items, CAST(sum(l.amount) AS BIGINT) AS amount
FROM lines l LEFT JOIN next_days n ON CAST(l.created AS DATE) = n.d GROUP BY ALL""",
    "latest_index": f"""WITH {INDEX}
SELECT round(value, 6) AS "latestValue", CAST(d AS VARCHAR) AS "latestDate" FROM latest""",
    "index_with_forecast": f"""WITH {INDEX}
SELECT CAST(d AS VARCHAR) AS "referenceDate", working AS "isWorkingDay", round(value, 6) AS "indexValue",
       forecast AS "isForecast" FROM factors""",
    "compound_return": f"""WITH {INDEX}
SELECT CAST(d AS VARCHAR) AS "referenceDate", working AS "isWorkingDay", round(value, 6) AS "indexValue",
       forecast AS "isForecast", round(by_settlement, 6) AS "accumulatedReturn", round(by_due, 6) AS "returnByDueDate"
FROM returns""",
    "purchase_log": f"""WITH {LOG}
SELECT id AS "endToEndId", lid AS "issuingPurchaseLogId", strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS "logTime",
       CAST(d AS VARCHAR) AS "logDate", type, amount AS "logAmount", CAST(confirmed_on AS VARCHAR) AS "purchaseConfirmed",
       strftime(confirmed_at, '%Y-%m-%d %H:%M:%S.%f') AS "confirmedTime", issuer AS "subIssuerTaxId" FROM log""",
    "cycle_attribution": f"""WITH {CYCLES}
SELECT id AS "endToEndId", lid AS "issuingPurchaseLogId", type, CAST(d AS VARCHAR) AS "logDate", amount AS "logAmount",
       CAST(cycle AS VARCHAR) AS "cycleDate", internal AS "internalId" FROM attributed""",
    "classify_reversals": f"""WITH {CYCLES}
SELECT lid AS "issuingPurchaseLogId", id AS "endToEndId", CAST(cycle AS VARCHAR) AS "cycleDate",
       CAST(d AS VARCHAR) AS "logDate", amount AS "logAmount", early AS "beforeSettlement"
FROM attributed WHERE type = 'reversed'""",
    "cycle_amounts": f"""WITH {CYCLES} SELECT * FROM amounts""",
    "cycle_remuneration": f"""WITH {CYCLES}, {INDEX},
joined AS (
  SELECT a.*, r.by_settlement AS acc, "confirmedAmount" - coalesce("reversedBeforeSettlement", 0) AS net
  FROM amounts a LEFT JOIN returns r ON a."settlementDate" = CAST(r.d AS VARCHAR)),
paid AS (SELECT *, CAST(round(coalesce(net * acc - net, 0) * CAST(0.6 AS DOUBLE)) AS BIGINT) AS remuneration FROM joined)
SELECT * EXCLUDE (acc, net), round(acc, 6) AS "accumulatedReturn", net AS "netAmount",
       greatest(remuneration, 0) AS "nonNegativeRemuneration" FROM paid""",
    "prior_row_cycle": f"""WITH {PREVIOUS_ROW}, {INDEX},
joined AS (
  SELECT a.*, r.by_settlement AS acc, CAST(confirmed - coalesce(before, 0) AS BIGINT) AS net
  FROM amounts a LEFT JOIN returns r ON a.settled = r.d),
paid AS (SELECT *, CAST(round(coalesce(net * acc - net, 0) * CAST(0.6 AS DOUBLE)) AS BIGINT) AS remuneration FROM joined)
SELECT id AS "endToEndId", CAST(day AS VARCHAR) AS "cycleDate", CAST(confirmed_on AS VARCHAR) AS "confirmationDate",
       CAST(due AS VARCHAR) AS "dueDate", CAST(settled AS VARCHAR) AS "settlementDate",
       CAST(confirmed AS BIGINT) AS "confirmedAmount", CAST(before AS BIGINT) AS "reversedBeforeSettlement",
       CAST(after AS BIGINT) AS "reversedAfterSettlement", round(acc, 6) AS "accumulatedReturn", net AS "netAmount",
       remuneration, greatest(remuneration, 0) AS "nonNegativeRemuneration" FROM paid""",
    "issuer_daily_remuneration": _issuer_daily_remuneration("ts", "confirmed_at"),
    "issuer_daily_remuneration_by_day": _issuer_daily_remuneration("d", "confirmed_on"),
    "previous_event_lookup": f"""WITH {LOG},
looked AS (
  SELECT *, last_value(CASE WHEN type <> 'reversed' THEN lid END IGNORE NULLS) OVER (
              PARTITION BY id ORDER BY ts, type, lid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS previous,
         row_number() OVER (PARTITION BY id, type ORDER BY ts, lid) AS number
  FROM log)
SELECT k.id AS "endToEndId", k.lid AS "issuingPurchaseLogId", k.number AS "rowNumber", k.type,
       CAST(coalesce(k.confirmed_on, k.d) AS VARCHAR) AS "logDate", CAST(k.confirmed_on AS VARCHAR) AS "purchaseConfirmed",
       k.previous AS "previousLogId", p.type AS "previousType", CAST(p.d AS VARCHAR) AS "previousDate",
       strftime(p.ts, '%Y-%m-%d %H:%M:%S.%f') AS "previousTime"
FROM looked k LEFT JOIN log p ON p.lid = k.previous WHERE k.type = 'reversed'""",
    "sub_issuer_dim": """SELECT CAST(c_nationkey AS VARCHAR) AS "subIssuerTaxId", min(c_mktsegment) AS "subIssuerName"
FROM customer WHERE c_nationkey IS NOT NULL GROUP BY ALL""",
    "card_expirations": f"""WITH {EVENTS}
SELECT card AS "issuingCardId", card_type AS "cardType", 'expiration' AS type, CAST(expiration AS VARCHAR) AS "logCreated",
       holder AS "issuingHolderId", issuer AS "subIssuerTaxId" FROM expirations""",
    "first_card_events": f"""WITH {EVENTS}
SELECT card AS "issuingCardId", card_type AS "cardType", type, strftime(happened, '%Y-%m-%d %H:%M:%S.%f') AS "logCreated"
FROM first_events""",
    "card_events": f"""WITH {EVENTS}
SELECT a.card AS "issuingCardId", a.card_type AS "cardType", a.type, strftime(a.happened, '%Y-%m-%d %H:%M:%S.%f') AS "logCreated",
       e.holder AS "issuingHolderId", e.issuer AS "subIssuerTaxId" FROM all_events a LEFT JOIN expirations e USING (card)""",
    "activity_delta": f"""WITH {DELTAS}
SELECT card AS "issuingCardId", card_type AS "cardType", type, holder AS "issuingHolderId", issuer AS "subIssuerTaxId",
       CAST(quarter AS VARCHAR) AS quarter, CAST(delta AS BIGINT) AS delta, number AS "eventNumber" FROM deltas""",
    "holder_activity": f"""WITH {HOLDERS}
SELECT holder AS "issuingHolderId", issuer AS "subIssuerTaxId", CAST(quarter AS VARCHAR) AS quarter,
       CAST(delta AS BIGINT) AS delta FROM activity""",
    "holder_balance": f"""WITH {HOLDERS}
SELECT holder AS "issuingHolderId", issuer AS "subIssuerTaxId", CAST(quarter AS VARCHAR) AS quarter,
       CAST(balance AS BIGINT) AS balance FROM balances""",
    "densify_fill": f"""WITH {HOLDERS}
SELECT holder AS "issuingHolderId", issuer AS "subIssuerTaxId", CAST(quarter AS VARCHAR) AS quarter,
       CAST(balance AS BIGINT) AS balance FROM dense WHERE quarter <= DATE '2000-01-01'""",
    "active_holders": f"""WITH {HOLDERS}
SELECT issuer AS "subIssuerTaxId", CAST(quarter AS VARCHAR) AS quarter, holders FROM active""",
    "active_holders_report": f"""WITH {HOLDERS}
SELECT CAST(g.quarter AS VARCHAR) AS quarter, a.issuer AS "subIssuerTaxId", g.n_name AS "subIssuerName", a.holders
FROM (SELECT quarter, n_name, CAST(n_nationkey AS VARCHAR) AS issuer FROM quarters CROSS JOIN nation) g
ASOF JOIN active a ON g.issuer = a.issuer AND g.quarter >= a.quarter""",
    "card_balance_listing": f"""WITH {DELTAS},
running AS (
  SELECT card, issuer_name, quarter, sum(delta) OVER (
           PARTITION BY card ORDER BY quarter, number ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS balance
  FROM deltas WHERE issuer_name = 'NATION_3')
SELECT card AS "issuingCardId", issuer_name AS "subIssuerName", CAST(quarter AS VARCHAR) AS quarter,
       CAST(balance AS BIGINT) AS balance FROM running WHERE balance <> 0 AND quarter >= DATE '1998-01-01'""",
    "partner_list_check": f"""WITH {RECONCILED},
of_quarter AS (
  SELECT card, issuer_name, quarter, sum(delta) OVER (
           PARTITION BY card ORDER BY quarter, number ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS balance
  FROM deltas WHERE issuer_name = 'NATION_3' AND quarter = DATE '2000-01-01')
SELECT p.card AS "issuingCardId", p.origin, q.issuer_name AS "subIssuerName", CAST(q.quarter AS VARCHAR) AS quarter,
       CAST(q.balance AS BIGINT) AS balance, s.status
FROM partner p LEFT JOIN of_quarter q USING (card) LEFT JOIN status s USING (card) WHERE q.balance <= 0""",
    "card_collection": f"""WITH {RECONCILED}
SELECT card AS "issuingCardId", issuer_name AS "subIssuerName", card_type AS "cardType" FROM collection""",
    "peak_balance": f"""WITH {RECONCILED}
SELECT card AS "issuingCardId", CAST(quarter AS VARCHAR) AS quarter, CAST(balance AS BIGINT) AS balance FROM peaks""",
    "balance_at_quarter": f"""WITH {RECONCILED}
SELECT card AS "issuingCardId", issuer_name AS "subIssuerName", card_type AS "cardType",
       CAST(quarter AS VARCHAR) AS quarter, CAST(balance AS BIGINT) AS balance FROM own""",
    "card_status": """SELECT card AS "issuingCardId", status FROM (
  SELECT CAST(o_orderkey AS VARCHAR) AS card, o_orderstatus AS status,
         row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate, o_orderstatus) AS rn FROM orders) WHERE rn = 1""",
    "reconcile_matched": f"""WITH {RECONCILED} SELECT {CARD_COLUMNS} FROM listed WHERE balance > 0""",
    "reconcile_only_partner": f"""WITH {RECONCILED} SELECT {CARD_COLUMNS} FROM listed WHERE balance <= 0""",
    "reconcile_flag_unknown": f"""WITH {RECONCILED},
flagged AS (SELECT * REPLACE (coalesce(balance, -1000) AS balance, CASE WHEN balance IS NOT NULL THEN card_type END AS card_type) FROM listed)
SELECT {CARD_COLUMNS} FROM flagged WHERE balance <= 0""",
    "reconcile_only_own": f"""WITH {RECONCILED} SELECT {CARD_COLUMNS} FROM missing""",
    "divergence_report": f"""WITH {RECONCILED} SELECT {CARD_COLUMNS} FROM divergent""",
    "divergences_by_tree": f"""WITH {RECONCILED} SELECT {CARD_COLUMNS} FROM divergent""",
    "issuer_divergences": f"""WITH {RECONCILED}
SELECT v.card AS "issuingCardId", v.origin, CAST(v.balance AS BIGINT) AS balance, v.card_type AS "cardType", v.status
FROM divergent v JOIN collection c ON v.card = c.card WHERE c.issuer_name = 'NATION_3'""",
    "event_history": _history("origin IS NULL"),
    "event_history_partner": _history("balance <= 0 AND origin = 'partner'"),
    "event_history_arrays": _history_arrays("origin IS NULL"),
    "explode_history": f"""WITH {HISTORY}
SELECT {CARD_COLUMNS}, list_min(dates) AS "eventDate", 'canceled' AS event
FROM histories WHERE origin IS NULL AND list_contains(types, 'canceled')""",
    "explode_history_zip": f"""WITH {HISTORY}
SELECT {CARD_COLUMNS}, CAST(min(CAST(happened AS DATE)) AS VARCHAR) AS "eventDate", type AS event
FROM missing JOIN (SELECT card, happened, type FROM card_log) USING (card)
WHERE NOT (card_type = 'physical' AND type = 'created') AND NOT (card_type = 'virtual' AND type = 'unblocked')
GROUP BY ALL""",
    "resolve_holder": f"""WITH {RECONCILED},
holders AS (SELECT card, min(holder) AS holder FROM card_log GROUP BY ALL)
SELECT p.card AS "issuingCardId", h.holder AS "issuingHolderId" FROM partner p LEFT JOIN holders h USING (card)""",
    "nominal_due": f"""WITH {LINES}
SELECT id AS "installmentId", CAST(CAST(due - INTERVAL 3 HOUR AS DATE) AS VARCHAR) AS "nominalDue",
       CAST(CAST(created - INTERVAL 3 HOUR AS DATE) AS VARCHAR) AS "installmentCreated" FROM lines""",
    "acquirer_due": f"""WITH {DUE}
SELECT id AS "installmentId", CAST(nominal AS VARCHAR) AS "nominalDue", CAST(created_on AS VARCHAR) AS "installmentCreated",
       CAST(acquirer_due AS VARCHAR) AS "dueFromAcquirer" FROM acquirer_dues""",
    "workspace_dim": """SELECT "workspaceId", "companyTaxId", "companyName" FROM (
  SELECT CAST(o_custkey AS VARCHAR) AS "workspaceId", o_orderstatus AS "companyTaxId", o_orderpriority AS "companyName",
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderstatus, o_orderpriority) AS rn
  FROM orders) WHERE rn = 1""",
    "factoring_flag": f"""WITH {LINES} SELECT id AS "installmentId", l_quantity >= 46 AS "isFactoring" FROM lines""",
    "installment_fact": f"""WITH {FACT}
SELECT f.id AS "installmentId", split_part(f.id, '-', 1) AS "purchaseId", split_part(f.id, '-', 1) AS "acquiringId",
       'e' || split_part(f.id, '-', 1) AS "endToEndId", p.funding AS "fundingType", f.purchase_status AS "purchaseStatus",
       CAST(created_on AS VARCHAR) AS "createdDate", CAST(created_on AS VARCHAR) AS "installmentCreated",
       CAST(merchant_due AS VARCHAR) AS "merchantDue", CAST(nominal AS VARCHAR) AS "nominalDue",
       CAST(acquirer_due AS VARCHAR) AS "dueFromAcquirer", network, workspace AS "workspaceId",
       f.status AS "installmentStatus", amount, fee, CAST(external AS BIGINT) AS "externalFee", factoring AS "isFactoring"
FROM fact f JOIN merchant_purchases p ON split_part(f.id, '-', 1) = p.purchase""",
    "created_rollup": _rollup_query(CREATED),
    "merchant_due_rollup": _rollup_query(MERCHANT),
    "acquirer_due_rollup": _rollup_query(ACQUIRER),
    "daily_receive_pay": f"""WITH {FACT}, created_side AS ({CREATED}), acquirer_side AS ({ACQUIRER}), merchant_side AS ({MERCHANT}),
spine AS (
  SELECT CAST(unnest(generate_series(CAST((SELECT min(ref) FROM created_side) AS TIMESTAMP),
                                     CAST((SELECT max(ref) FROM merchant_side) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS ref),
created_days AS (
  SELECT s.ref, c.network, c.status, c.workspace, c.factoring FROM spine s LEFT JOIN created_side c USING (ref)),
with_acquirer AS (
  SELECT ref, network, status, workspace, c.factoring, a.* EXCLUDE (ref, network, status, workspace, factoring)
  FROM created_days c FULL JOIN acquirer_side a USING (ref, network, status, workspace)),
with_both AS (
  SELECT ref, network, status, workspace, w.* EXCLUDE (ref, network, status, workspace),
         m.* EXCLUDE (ref, network, status, workspace, factoring)
  FROM with_acquirer w FULL JOIN merchant_side m USING (ref, network, status, workspace))
SELECT CAST(ref AS VARCHAR) AS "referenceDate", s_name AS "companyName", factoring AS "isFactoring", network,
       status AS "installmentStatus", b.* EXCLUDE (ref, network, status, workspace, factoring)
FROM with_both b LEFT JOIN supplier ON workspace = CAST(s_suppkey AS VARCHAR)""",
    "publish_roundtrip": """SELECT CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS VARCHAR) AS month, l_orderkey, l_linestatus,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS amount FROM lineitem""",
    "signed_purchases": f"""WITH {CONVERTED}
SELECT CASE o_orderstatus WHEN 'O' THEN 'confirmed' ELSE 'reversed' END AS type, CAST(o_orderkey AS VARCHAR) AS "endToEndId",
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS "logCreated", CAST(c_nationkey AS VARCHAR) AS "subIssuerId",
       CAST(o_custkey AS VARCHAR) AS "holderId", CAST(o_orderkey AS VARCHAR) AS "cardId", currency AS "merchantCurrencyCode",
       c_mktsegment AS purpose, o_orderpriority AS "methodCode",
       CAST(CAST(o_orderdate - INTERVAL 3 HOUR AS DATE) AS VARCHAR) AS "purchaseCreated",
       CASE o_orderstatus WHEN 'P' THEN -cents ELSE cents END AS "logAmount", currency AS "networkCurrencyCode",
       cents AS "issuerAmount", CAST(network AS BIGINT) AS "networkAmount", fee, merchant_fee AS "merchantFee",
       CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS BIGINT) AS cycle,
       CAST(confirmed AS VARCHAR) AS "purchaseConfirmed", c_mktsegment AS "merchantCategoryCode"
FROM calculated""",
    "conversion_columns": f"""WITH {CONVERTED}
SELECT CAST(o_orderkey AS VARCHAR) AS "endToEndId", round(rate, 6) AS "conversionRate", round(spread, 6) AS spread,
       CAST(conciliated AS VARCHAR) AS "purchaseConciliated", merchant_fee AS "merchantFeeBRL",
       round(fee * rate, 2) AS "feeBRL", round(rate * (1 + spread), 4) AS "conversionRateIssuer" FROM calculated""",
    "enrich": f"""WITH {CONVERTED},
categories AS (SELECT c_mktsegment AS code, CAST(min(c_custkey) AS VARCHAR) AS number FROM customer GROUP BY ALL)
SELECT CAST(o_orderkey AS VARCHAR) AS "endToEndId", CASE o_orderstatus WHEN 'P' THEN -cents ELSE cents END AS "logAmount",
       c_name AS "holderName", CAST(c_nationkey AS VARCHAR) AS "workspaceId", c_mktsegment AS "centerId",
       n_name AS "companyName", CAST(n_regionkey AS VARCHAR) AS "companyTaxId", o_orderpriority AS "binId",
       raw_card_type AS "cardType", CAST(n_nationkey AS VARCHAR) AS "subIssuerWorkspaceId", n_name AS "subIssuerName",
       number AS "merchantCategoryNumber" FROM calculated JOIN categories ON c_mktsegment = code""",
    "weekly_tpv": f"""WITH {RECORDS},
weeks AS (
  SELECT *, CAST(o_orderdate AS DATE) - CAST(dayofweek(o_orderdate) AS INTEGER) AS week,
         CASE o_orderstatus WHEN 'F' THEN 'Physical' WHEN 'O' THEN 'Virtual' END AS shown_type
  FROM records WHERE c_nationkey <> 5),
grouped AS (
  SELECT week, n_name, currency, c_mktsegment, shown_type, sum(cents) AS cents, count(o_orderkey) AS n FROM weeks GROUP BY ALL),
labelled AS (
  SELECT *, date_diff('day', week, DATE '2001-07-29') // 7 AS ago,
         strftime(week, '%d/%b') || ' to ' || strftime(week + 6, '%d/%b') AS label,
         CAST(0.005 AS DOUBLE) * cents / 100 + CAST(0.25 AS DOUBLE) AS local_revenue,
         CAST(0.014 AS DOUBLE) * cents / 100 + CAST(0.5 AS DOUBLE) AS foreign_revenue
  FROM grouped)
SELECT CAST(week AS VARCHAR) AS week, CAST(ago AS BIGINT) AS "weeksAgo", label AS "weekText", ago || '. ' || label AS "weekLabel",
       n_name AS "subIssuerName", currency AS "networkCurrencyCode", c_mktsegment AS purpose, shown_type AS "cardType",
       CASE WHEN currency = 'BRL' THEN round(cents / 100, 6) END AS "nationalTPV",
       CASE WHEN currency <> 'BRL' THEN round(cents / 100, 6) END AS "internationalTPV",
       CASE WHEN currency = 'BRL' THEN round(local_revenue, 6) END AS "nationalRevenue",
       CASE WHEN currency <> 'BRL' THEN round(foreign_revenue, 6) END AS "internationalRevenue",
       CASE WHEN currency = 'BRL' THEN n END AS "nationalTRX", CASE WHEN currency <> 'BRL' THEN n END AS "internationalTRX",
       round(cents / 100, 6) AS "totalTPV",
       CASE WHEN currency = 'BRL' THEN round(local_revenue, 6) WHEN currency <> 'BRL' THEN round(foreign_revenue, 6) END AS "totalRevenue",
       n AS "totalTRX" FROM labelled""",
    "normalise_decimals": f"""WITH {REPORT}
SELECT id AS "NSU_CV", number AS parcela, sold AS data_original_da_venda,
       printf('%.2f', l_extendedprice) AS valor_bruto_da_parcela_original, l_linestatus AS status FROM sales""",
    "typed_dates": f"""WITH {REPORT}
SELECT id AS "NSU_CV", number AS parcela, sold_iso AS data_original_da_venda, gross AS valor_bruto_da_parcela_original,
       l_linestatus AS status FROM sales""",
    "apply_schema": f"""WITH {REPORT}
SELECT id AS "NSU_CV", CAST(number AS BIGINT) AS parcela, sold_iso AS data_original_da_venda,
       l_extendedprice AS valor_bruto_da_parcela_original, l_linestatus AS status FROM sales""",
    "outer_union": f"""WITH {REPORT}
SELECT id AS "NSU_CV", NULL AS bandeira, NULL AS data_do_recebimento, sold AS data_original_da_venda, number AS parcela,
       l_linestatus AS status, gross AS valor_bruto_da_parcela_original, NULL AS valor_liquido_da_parcela FROM sales
UNION ALL
SELECT id, l_returnflag, sold, NULL, NULL, NULL, NULL, net FROM sales""",
    "stamp": f"""WITH {REPORT}
SELECT '2024-01-31' AS updated_on, id AS "NSU_CV", sold AS data_do_recebimento, net AS valor_liquido_da_parcela,
       l_returnflag AS bandeira FROM sales""",
    "read_zipped_reports": f"""WITH {REPORT}
SELECT '2024-01-31' AS updated_on, id AS "NSU_CV", CAST(number AS BIGINT) AS parcela, sold_iso AS data_original_da_venda,
       l_extendedprice AS valor_bruto_da_parcela_original, l_linestatus AS status FROM sales""",
    "parse_day_label": f"""WITH {CAPTURED} SELECT event_id, label, CAST(parsed AS VARCHAR) AS data FROM labelled""",
    "parse_money": f"""WITH {CAPTURED} SELECT event_id, value, cut AS valor, valor AS rounded FROM labelled""",
    "collect_statements": f"""WITH {CAPTURED}
SELECT strftime(updated_on, '%Y-%m-%d %H:%M:%S.%f') AS updated_on, CAST(parsed AS VARCHAR) AS data, tipo, cut AS valor FROM labelled""",
    "snapshot_merge": f"""WITH {SNAPSHOTS},
history AS (SELECT updated_on, data, tipo, valor FROM snapshots WHERE updated_on < TIMESTAMP '2024-01-16'),
new AS (SELECT updated_on, data, tipo, valor FROM snapshots WHERE updated_on >= TIMESTAMP '2024-01-16'), {MERGE}""",
    "snapshot_update": f"""WITH {CAPTURED},
history AS (SELECT updated_on, data, tipo, valor FROM snapshots WHERE updated_on < TIMESTAMP '2024-01-16'),
new AS (SELECT updated_on, parsed AS data, tipo, cut AS valor FROM labelled WHERE updated_on >= TIMESTAMP '2024-01-16'), {MERGE}""",
    "snapshot_empty_update": f"""WITH {SNAPSHOTS}
SELECT strftime(updated_on, '%Y-%m-%d %H:%M:%S.%f') AS updated_on, CAST(data AS VARCHAR) AS data, tipo, valor FROM snapshots""",
    "snapshot_unreadable": f"""WITH {SNAPSHOTS}
SELECT 'since ' || strftime(updated_on, '%H') || 'h' AS label, count(*) AS rows FROM snapshots
WHERE minute(updated_on) < 10 GROUP BY ALL""",
    "land_reports": f"""WITH {REPORT}
SELECT fmt, '2024-01-31' AS updated_on, id AS "NSU_CV", number AS parcela, sold_iso AS data_original_da_venda,
       l_extendedprice AS valor_bruto_da_parcela_original, l_linestatus AS status
FROM sales, (VALUES ('csv'), ('parquet')) AS f(fmt)""",
    "landing_problems": """SELECT member, kind, count(*) AS archives
FROM (SELECT DISTINCT l_orderkey % 16 AS archive FROM lineitem),
     (VALUES ('recebidos-1.csv', 'recebidos'), ('outros-2.csv', 'outros'), ('ajustes-1.xlsx', 'ajustes')) AS m(member, kind)
GROUP BY ALL
UNION ALL
SELECT NULL, NULL, 1""",
    "landing_lost_values": """SELECT 'pagamentos' AS kind, 'data_original_da_venda' AS "column", count(*) AS lost
FROM lineitem WHERE l_tax = 0 OR l_linenumber = 1""",
} | store_oracles.ORACLES
# What is adjusted has to be what a full run makes.
ORACLES["active_holders_incremental"] = ORACLES["active_holders_report"]
ORACLES["receive_pay_incremental"] = ORACLES["daily_receive_pay"]
