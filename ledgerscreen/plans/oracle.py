"""Independent SQL (DuckDB dialect) for every registered query.

Each query is one ``WITH`` chain over the raw test tables that re-derives the
ledger, the planted rows, the cleaned table, the shared aggregates, the rule
columns, the features, the forest (level by level, one CTE per depth), the
scores and the risk table -- so the Spark plans are checked end to end against
a different engine.  Generated from the same parameters as the Spark side.
"""

from __future__ import annotations

import math

from ledgerscreen.params import (DEFAULT_PARAMS, MONTH_END_MONTHS, OFF_HOURS_NIGHT, PLANT_BASE_ROWS, PLANT_KINDS,
                                 REASON_DUPLICATE, REASON_MONTH_END, REASON_OFF_HOURS, REASON_ROUND,
                                 ROUND_AMOUNTS, RULE_NAMES, SEVERITY, Params)

P = DEFAULT_PARAMS
EULER_GAMMA = 0.5772156649015329
FIXED = 1_000_000_000        # unit of a path length
D = "::DOUBLE"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def h32(*parts: str) -> str:
    return f"CAST(CAST(('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 8)) AS UBIGINT) AS BIGINT)"


def hunit(*parts: str) -> str:
    return f"((CAST({h32(*parts)} AS DOUBLE) + 0.5{D}) / 4294967296.0{D})"


def half_even(x: str, digits: int) -> str:
    """numpy's rounding: scale, nearest (even on a tie), unscale."""
    y = f"(({x}) * {10 ** digits}.0{D})"
    up = f"({y} - floor({y}) > 0.5{D} OR ({y} - floor({y}) = 0.5{D} AND CAST(floor({y}) AS BIGINT) % 2 <> 0))"
    return f"((floor({y}) + CASE WHEN {up} THEN 1 ELSE 0 END) / {10 ** digits}.0{D})"


def lp2(x: str) -> str:
    return f"lpad(CAST({x} AS VARCHAR), 2, '0')"


def hhmmss(sec: str) -> str:
    return f"({lp2(f'({sec}) // 3600')} || ':' || {lp2(f'(({sec}) // 60) % 60')} || ':' || {lp2(f'({sec}) % 60')})"


RAW = "transaction_id, date, time, department, account, vendor, amount, entry_type, posted_by, description"
CLEAN = RAW + ", day_of_week, is_weekend, hour, month, day"


class Chain:
    def __init__(self):
        self.ctes: list[tuple[str, str]] = []

    def add(self, name: str, sql: str) -> "Chain":
        self.ctes.append((name, sql))
        return self

    def sql(self, final: str) -> str:
        body = ",\n".join(f"{n} AS (\n{s}\n)" for n, s in self.ctes)
        return f"WITH {body}\n{final}"


# ---------------------------------------------------------------- sources

def lineitem_ledger(c: Chain, name: str = "base") -> None:
    tid = ("'JE-' || l.l_orderkey || '-' || l.l_linenumber || '-' || l.l_partkey || '-' || l.l_suppkey"
           " || '-' || CAST(trunc(l.l_quantity) AS BIGINT)")
    c.add(f"{name}_j", f"""
SELECT {tid} AS transaction_id, CAST(l.l_shipdate AS DATE) AS date,
       c.c_mktsegment AS department, p.p_type AS account, n.n_name AS vendor,
       l.l_extendedprice AS amount,
       CASE WHEN l.l_linestatus = 'F' THEN 'Debit' ELSE 'Credit' END AS entry_type,
       'USER_' || CAST(o.o_custkey % 25 AS VARCHAR) AS posted_by, p.p_name AS description
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey""")
    c.add(name, f"""
SELECT transaction_id, date, {hhmmss(h32('transaction_id') + ' % 86400')} AS time,
       department, account, vendor, amount, entry_type, posted_by, description
FROM {name}_j""")


def events_ledger(c: Chain, name: str = "ev_base") -> None:
    c.add(name, """
SELECT 'EV' || CAST(e.event_id AS VARCHAR) AS transaction_id, CAST(e.ts AS DATE) AS date,
       strftime(e.ts, '%H:%M:%S') AS time, c.c_mktsegment AS department, e.event_type AS account,
       'USER_' || CAST(e.user_id AS VARCHAR) AS vendor, e.value AS amount,
       CASE WHEN e.event_type = 'purchase' THEN 'Debit' ELSE 'Credit' END AS entry_type,
       'USER_' || CAST(e.user_id % 25 AS VARCHAR) AS posted_by, e.props AS description
FROM events e JOIN customer c ON e.user_id = c.c_custkey""")


# ---------------------------------------------------------------- planting

def _ph(kind: str, tag: str) -> str:
    return h32(q(str(P.plant_seed)), q(kind), q(tag), "transaction_id")


def _pu(kind: str, tag: str) -> str:
    return hunit(q(str(P.plant_seed)), q(kind), q(tag), "transaction_id")


def plant_kind_sql(kind: str, src: str = "base") -> str:
    # one hash per row, cut in consecutive ranges of count / base rows each
    widths = [int(n / PLANT_BASE_ROWS * 4294967296.0) for _, n in PLANT_KINDS]
    at = [k for k, _ in PLANT_KINDS].index(kind)
    lo, hi = sum(widths[:at]), sum(widths[:at + 1])
    ph = h32(q(str(P.plant_seed)), "'plant'", "transaction_id")
    pick = f"{ph} >= {lo} AND {ph} < {hi}"
    cols = {c: c for c in RAW.split(", ")}
    frm = f"FROM {src} WHERE {pick}"
    if kind == "round_number":
        arr = "[" + ", ".join(f"{a}{D}" for a in ROUND_AMOUNTS) + "]"
        cols["amount"] = f"list_element({arr}, CAST({_ph(kind, 'amount')} % {len(ROUND_AMOUNTS)} + 1 AS INTEGER))"
    elif kind == "off_hours_weekend":
        weekend = f"({_ph(kind, 'mode')} % 2 = 0)"
        shift = f"((12 - (isodow(date) - 1)) % 7 + {_ph(kind, 'sunday')} % 2)"
        cols["date"] = f"CASE WHEN {weekend} THEN date + CAST({shift} AS INTEGER) ELSE date END"
        night = "[" + ", ".join(str(h) for h in OFF_HOURS_NIGHT) + "]"
        hour = (f"CASE WHEN {weekend} THEN 9 + {_ph(kind, 'hour')} % 9 ELSE "
                f"list_element({night}, CAST({_ph(kind, 'hour')} % {len(OFF_HOURS_NIGHT)} + 1 AS INTEGER)) END")
        cols["time"] = f"{lp2(hour)} || ':' || {lp2(_ph(kind, 'minute') + ' % 60')} || ':00'"
        cols["amount"] = f"amount * (0.5{D} + {_pu(kind, 'factor')})"
    elif kind == "vendor_concentration":
        cols["vendor"] = q(P.shell_vendor)
        cols["department"] = q(P.shell_department)
        cols["account"] = q(P.shell_account)
        cols["entry_type"] = "'Debit'"
        cols["amount"] = f"amount * (1.2{D} + 1.3{D} * {_pu(kind, 'factor')})"
    elif kind == "statistical_outlier":
        frm = (f"FROM {src} JOIN (SELECT account AS _a, round(avg(amount), 2) AS _m FROM {src} GROUP BY account) mm "
               f"ON {src}.account = mm._a WHERE {pick} AND amount > mm._m")
        cols["amount"] = f"amount * (8.0{D} + 7.0{D} * {_pu(kind, 'factor')})"
    elif kind == "month_end_spike":
        months = "[" + ", ".join(str(m) for m in MONTH_END_MONTHS) + "]"
        m = f"list_element({months}, CAST({_ph(kind, 'month')} % {len(MONTH_END_MONTHS)} + 1 AS INTEGER))"
        d0 = f"(28 + {_ph(kind, 'day')} % 4)"
        y = "year(date)"
        last = f"day(last_day(make_date({y}, {m}, 1)))"
        cols["date"] = f"make_date({y}, {m}, CASE WHEN {d0} <= {last} THEN {d0} ELSE 28 END)"
        hour = f"(18 + {_ph(kind, 'hour')} % 6)"
        cols["time"] = f"{lp2(hour)} || ':' || {lp2(_ph(kind, 'minute') + ' % 60')} || ':00'"
        cols["department"] = q(P.month_end_department)
        cols["entry_type"] = "'Debit'"
        cols["amount"] = f"amount * (1.5{D} + 1.5{D} * {_pu(kind, 'factor')})"
    cols["transaction_id"] = f"'PL-{kind}-' || transaction_id"
    sel = ", ".join(f"{v} AS {k}" for k, v in cols.items())
    return f"SELECT {sel}, {q(kind)} AS anomaly_type {frm}"


def planted(c: Chain, src: str = "base") -> None:
    c.add("plants", "\nUNION ALL\n".join(plant_kind_sql(k, src) for k, _ in PLANT_KINDS))
    c.add("ledger", f"SELECT {RAW} FROM {src} UNION ALL SELECT {RAW} FROM plants")
    c.add("positives", "SELECT transaction_id, 1 AS is_anomaly, anomaly_type FROM plants")
    c.add("labels_all", f"SELECT transaction_id, 1 AS is_anomaly, anomaly_type FROM plants UNION ALL "
                        f"SELECT transaction_id, 0 AS is_anomaly, 'none' AS anomaly_type FROM {src}")


# ---------------------------------------------------------------- clean + rules

def clean(c: Chain, src: str, pre: str) -> None:
    part = "CAST(split_part(time, ':', {}) AS INTEGER)"
    hour = f"(({part.format(1)} * 3600 + {part.format(2)} * 60 + {part.format(3)}) // 3600) % 24"
    c.add(f"{pre}je0", f"""
SELECT {RAW}, dayname(date) AS day_of_week, isodow(date) >= 6 AS is_weekend,
       CASE WHEN regexp_full_match(time, '([01]?[0-9]|2[0-3]):[0-5]?[0-9]:([0-5]?[0-9]|6[01])')
            THEN CAST({hour} AS INTEGER) END AS hour,
       CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day
FROM {src}""")
    c.add(f"{pre}je", f"SELECT DISTINCT {CLEAN} FROM {pre}je0 "
                      "WHERE transaction_id IS NOT NULL AND date IS NOT NULL AND amount IS NOT NULL")


def dirty_ledger(c: Chain) -> None:
    """The all-text ledger made of ``orders``, then its typed form: one day format
    (year-month-day), plain decimal numbers, anything else is null."""
    day = "strftime(o_orderdate, '%Y-%m-%d')"
    clock = "(CAST(k % 24 AS VARCHAR) || ':' || lpad(CAST(k % 60 AS VARCHAR), 2, '0') || ':05')"
    price = "CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR)"
    c.add("dirty_text", f"""
SELECT CASE WHEN k % 29 = 1 THEN NULL ELSE 'OR' || k END AS transaction_id,
       CASE k % 23 WHEN 1 THEN o_orderpriority WHEN 2 THEN NULL WHEN 3 THEN strftime(o_orderdate, '%Y')
            WHEN 4 THEN '10:30:00'
            WHEN 5 THEN year(o_orderdate) || '-' || month(o_orderdate) || '-' || day(o_orderdate)
            WHEN 6 THEN {day} || ' 00:00:00' ELSE {day} END AS date,
       CASE k % 19 WHEN 1 THEN o_orderstatus WHEN 2 THEN NULL WHEN 3 THEN '23:59:60' WHEN 4 THEN '24:00:00'
            WHEN 5 THEN {clock} || ' ' ELSE {clock} END AS time,
       o_orderpriority AS department, o_orderstatus AS account, 'C' || o_custkey AS vendor,
       CASE k % 17 WHEN 1 THEN o_orderpriority WHEN 2 THEN NULL WHEN 3 THEN {price} || 'd'
            WHEN 4 THEN ' ' || {price} || ' ' WHEN 5 THEN '1,000.00' WHEN 6 THEN '1e3' ELSE {price} END AS amount,
       'Debit' AS entry_type, CAST(NULL AS VARCHAR) AS posted_by, o_orderpriority AS description
FROM (SELECT *, o_orderkey AS k, unnest(range(CASE WHEN o_orderkey % 40 = 0 THEN 2 ELSE 1 END)) AS copy FROM orders)""")
    c.add("dirty", f"""
SELECT * REPLACE (
  CASE WHEN regexp_full_match(date, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}')
       THEN TRY_CAST(split_part(date, '-', 1) || '-' || lpad(split_part(date, '-', 2), 2, '0') || '-'
                     || lpad(split_part(date, '-', 3), 2, '0') AS DATE) END AS date,
  CASE WHEN regexp_full_match(trim(amount), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
       THEN TRY_CAST(trim(amount) AS DOUBLE) END AS amount) FROM dirty_text""")


def quantile_expr(pos: str, vlo: str, vhi: str) -> str:
    return (f"CASE WHEN floor({pos}) = ceil({pos}) OR {vlo} = {vhi} THEN {vlo} "
            f"ELSE (ceil({pos}) - {pos}) * {vlo} + ({pos} - floor({pos})) * {vhi} END")


def group_quantiles(c: Chain, name: str, src: str, key: str, probs: dict) -> None:
    """Per-group quantiles with the same interpolation the Spark side uses."""
    c.add(f"{name}_r", f"""
SELECT {key}, amount, row_number() OVER (PARTITION BY {key} ORDER BY amount) - 1 AS rk,
       count(*) OVER (PARTITION BY {key}) AS n
FROM {src} WHERE {key} IS NOT NULL AND amount IS NOT NULL""")
    parts = []
    for col, pr in probs.items():
        pos = f"(CAST(n - 1 AS DOUBLE) * {pr}{D})"
        parts.append(f"max(CASE WHEN rk = floor({pos}) THEN amount END) AS {col}_lo, "
                     f"max(CASE WHEN rk = ceil({pos}) THEN amount END) AS {col}_hi, "
                     f"any_value({pos}) AS {col}_pos")
    c.add(f"{name}_s", f"SELECT {key}, n, {', '.join(parts)} FROM {name}_r GROUP BY {key}, n")
    outs = ", ".join(f"{quantile_expr(f'{k}_pos', f'{k}_lo', f'{k}_hi')} AS {k}" for k in probs)
    c.add(name, f"SELECT {key}, n, {outs} FROM {name}_s")


def enrich_rules(c: Chain, pre: str, p: Params = P) -> None:
    je = f"{pre}je"
    c.add(f"{pre}vs", f"SELECT vendor, count(*) AS vendor_n, sum(amount) AS vendor_sum FROM {je} GROUP BY vendor")
    c.add(f"{pre}tot", f"SELECT sum(vendor_sum) AS total_amount FROM {pre}vs")
    group_quantiles(c, f"{pre}acct", je, "account",
                    {"acct_q1": p.q_low, "acct_median": 0.5, "acct_q3": p.q_high})
    c.add(f"{pre}dups", f"SELECT vendor, amount, date, count(*) AS dup_n FROM {je} "
                        "GROUP BY vendor, amount, date HAVING count(*) > 1")
    c.add(f"{pre}en", f"""
SELECT j.*, vs.vendor_n, vs.vendor_sum, a.acct_q1, a.acct_median, a.acct_q3, d.dup_n, t.total_amount
FROM {je} j
LEFT JOIN {pre}vs vs ON j.vendor = vs.vendor
LEFT JOIN {pre}acct a ON j.account = a.account
LEFT JOIN {pre}dups d ON j.vendor IS NOT DISTINCT FROM d.vendor AND j.amount = d.amount AND j.date = d.date
CROSS JOIN {pre}tot t""")
    conc = q(p.concentration_reason)
    c.add(f"{pre}ru", f"""
SELECT *,
  CASE WHEN dup_n IS NOT NULL THEN {q(REASON_DUPLICATE)} END AS r_duplicate,
  CASE WHEN coalesce(amount % {p.round_base}{D} = 0 AND amount >= {p.round_min}{D}, false)
       THEN {q(REASON_ROUND)} END AS r_round_number,
  CASE WHEN coalesce(is_weekend, false) OR coalesce(hour < {p.business_start_hour}, false)
            OR coalesce(hour > {p.business_end_hour}, false) THEN {q(REASON_OFF_HOURS)} END AS r_off_hours_weekend,
  CASE WHEN vendor IS NOT NULL AND coalesce((vendor_sum / total_amount) * 100.0{D} > {p.concentration_pct}{D}, false)
       THEN {conc} END AS r_vendor_concentration,
  CASE WHEN account IS NOT NULL AND coalesce(amount > acct_q3 + {p.iqr_mult}{D} * (acct_q3 - acct_q1), false)
       THEN 'Statistical outlier for account ''' || account || ''' (IQR method)' END AS r_statistical_outlier,
  CASE WHEN coalesce(day >= {p.month_end_day} AND hour >= {p.late_hour}, false)
       THEN {q(REASON_MONTH_END)} END AS r_month_end_late_hour_posting
FROM {pre}en""")
    n = " + ".join(f"CASE WHEN r_{r} IS NOT NULL THEN 1 ELSE 0 END" for r in RULE_NAMES)
    names = ", ".join(f"CASE WHEN r_{r} IS NOT NULL THEN {q(r)} END" for r in RULE_NAMES)
    reasons = ", ".join(f"r_{r}" for r in RULE_NAMES)
    sev = ", ".join(f"CASE WHEN r_{r} IS NOT NULL THEN {SEVERITY[r]}{D} END" for r in RULE_NAMES)
    c.add(f"{pre}fl", f"""
SELECT *, CAST({n} AS INTEGER) AS n_tests_triggered,
       concat_ws(', ', {names}) AS tests_triggered,
       concat_ws(' | ', {reasons}) AS reasons,
       greatest({sev}, 0.0{D}) AS rule_severity
FROM {pre}ru""")
    c.add(f"{pre}flags", f"SELECT transaction_id, n_tests_triggered, tests_triggered, reasons "
                         f"FROM {pre}fl WHERE n_tests_triggered > 0")


# ---------------------------------------------------------------- features + forest

NUMERIC = {
    "hour": "CAST(coalesce(hour, -1) AS DOUBLE)",
    "is_weekend": "CAST(coalesce(CAST(is_weekend AS INTEGER), 0) AS DOUBLE)",
    "day": "CAST(coalesce(day, -1) AS DOUBLE)",
    "vendor_frequency": "CAST(coalesce(vendor_n, 0) AS DOUBLE)",
    "vendor_spend_share": f"coalesce(round(vendor_sum / total_amount, 9), 0.0{D})",
    "amount_vs_account_median": f"coalesce(round(CASE WHEN acct_median <> 0 THEN amount / acct_median END, 9), 0.0{D})",
}
CATEGORICAL = ("department", "account", "entry_type")


def features(c: Chain, pre: str) -> None:
    """The non-zero entries of the matrix: numbers, then one entry per category value."""
    fl = f"{pre}fl"
    parts = [f"SELECT transaction_id, {q(k)} AS feature, {v} AS value FROM {fl}" for k, v in NUMERIC.items()]
    parts += [f"SELECT transaction_id, {q(col + '_')} || {col} AS feature, 1.0{D} AS value FROM {fl} "
              f"WHERE {col} IS NOT NULL" for col in CATEGORICAL]
    c.add(f"{pre}feat_long", "SELECT * FROM (" + "\nUNION ALL\n".join(parts) + ") WHERE value <> 0")


def c_factor_sql(n: str) -> str:
    nd = f"CAST({n} AS DOUBLE)"
    return (f"(CASE WHEN {n} <= 1 THEN 0.0{D} WHEN {n} = 2 THEN 1.0{D} ELSE "
            f"2.0{D} * (ln({nd} - 1.0{D}) + {EULER_GAMMA!r}{D}) - 2.0{D} * ({nd} - 1.0{D}) / {nd} END)")


def forest(c: Chain, pre: str, p: Params = P) -> None:
    t, psi = p.n_trees, p.max_samples
    seed = q(str(p.seed))
    je = f"{pre}je"
    c.add(f"{pre}nrows", f"SELECT count(*) AS n FROM {je}")
    c.add(f"{pre}fpar", f"""
SELECT n, least({psi}, n) AS psi_eff,
       CAST(ceil(log2(greatest(least({psi}, n), 2))) AS INTEGER) AS dmax
FROM {pre}nrows""")
    pool_key = f"md5(concat_ws(':', {seed}, 'pool', transaction_id))"
    c.add(f"{pre}pool", f"""
SELECT transaction_id, row_number() OVER (ORDER BY {pool_key}, transaction_id) - 1 AS r FROM {je}
QUALIFY r < {t * psi}""")
    # dealt circularly: slot s of all trees' places holds the row of rank s modulo the pool
    c.add(f"{pre}samp", f"""
SELECT CAST(s.slot // (SELECT psi_eff FROM {pre}fpar) AS INTEGER) AS tree, p.transaction_id
FROM (SELECT unnest(range((SELECT {t} * psi_eff FROM {pre}fpar))) AS slot) s
JOIN {pre}pool p ON p.r = s.slot % (SELECT count(*) FROM {pre}pool)""")
    # the sample's numbers in long form, and its category values
    fl = f"{pre}fl"
    ids = f"(SELECT DISTINCT transaction_id FROM {pre}samp)"
    c.add(f"{pre}snum", "\nUNION ALL\n".join(
        f"SELECT transaction_id, {q(k)} AS feature, {v} AS value FROM {fl} SEMI JOIN {ids} USING (transaction_id)"
        for k, v in NUMERIC.items()))
    c.add(f"{pre}scat", "\nUNION ALL\n".join(
        f"SELECT transaction_id, {q(col)} AS feature, {col} AS category FROM {fl} SEMI JOIN {ids} USING (transaction_id) "
        f"WHERE {col} IS NOT NULL" for col in CATEGORICAL))
    c.add(f"{pre}lv0", f"SELECT tree, transaction_id, CAST(1 AS BIGINT) AS node FROM {pre}samp")
    max_levels = int(math.ceil(math.log2(max(psi, 2))))
    node_ctes = []
    for d in range(max_levels + 1):
        lv = f"{pre}lv{d}"
        c.add(f"{pre}cn{d}", f"SELECT tree, node, count(*) AS size FROM {lv} GROUP BY tree, node")
        leaf = f"CAST({d} AS BIGINT) * {FIXED} + CAST(floor({c_factor_sql('n.size')} * {FIXED}.0{D} + 0.5{D}) AS BIGINT)"
        if d < max_levels:
            c.add(f"{pre}st{d}", f"""
SELECT l.tree, l.node, f.feature, CAST(NULL AS VARCHAR) AS category, f.feature AS label,
       min(f.value) AS mn, max(f.value) AS mx
FROM {lv} l JOIN {pre}snum f ON l.transaction_id = f.transaction_id
GROUP BY l.tree, l.node, f.feature HAVING min(f.value) < max(f.value)
UNION ALL
SELECT l.tree, l.node, f.feature, f.category, f.feature || '_' || f.category AS label, 0.0{D}, 1.0{D}
FROM {lv} l JOIN {pre}scat f ON l.transaction_id = f.transaction_id
JOIN {pre}cn{d} n ON n.tree = l.tree AND n.node = l.node
GROUP BY l.tree, l.node, f.feature, f.category, n.size HAVING count(*) < n.size""")
            fkey = f"md5(concat_ws(':', {seed}, CAST(s.tree AS VARCHAR), CAST(s.node AS VARCHAR), label)) || label"
            u = hunit(seed, "CAST(s.tree AS VARCHAR)", "CAST(s.node AS VARCHAR)", "'split'")
            c.add(f"{pre}sp{d}", f"""
SELECT s.tree, s.node, s.feature, s.category, s.mn + {u} * (s.mx - s.mn) AS split
FROM {pre}st{d} s JOIN {pre}cn{d} n ON s.tree = n.tree AND s.node = n.node
WHERE n.size > 1 AND {d} < (SELECT dmax FROM {pre}fpar)
QUALIFY row_number() OVER (PARTITION BY s.tree, s.node ORDER BY {fkey}) = 1""")
            c.add(f"{pre}nd{d}", f"""
SELECT n.tree, n.node, {d} AS depth, n.size, s.feature, s.category, s.split,
       CASE WHEN s.feature IS NULL THEN {leaf} END AS leaf_value
FROM {pre}cn{d} n LEFT JOIN {pre}sp{d} s ON n.tree = s.tree AND n.node = s.node""")
            c.add(f"{pre}lv{d + 1}", f"""
SELECT l.tree, l.transaction_id,
       CASE WHEN CASE WHEN s.category IS NULL THEN f.value < s.split ELSE g.category IS DISTINCT FROM s.category END
            THEN 2 * l.node ELSE 2 * l.node + 1 END AS node
FROM {lv} l JOIN {pre}sp{d} s ON l.tree = s.tree AND l.node = s.node
LEFT JOIN {pre}snum f ON f.transaction_id = l.transaction_id AND f.feature = s.feature
LEFT JOIN {pre}scat g ON g.transaction_id = l.transaction_id AND g.feature = s.feature""")
        else:
            c.add(f"{pre}nd{d}", f"""
SELECT n.tree, n.node, {d} AS depth, n.size, CAST(NULL AS VARCHAR) AS feature, CAST(NULL AS VARCHAR) AS category,
       CAST(NULL AS DOUBLE) AS split, {leaf} AS leaf_value
FROM {pre}cn{d} n""")
        node_ctes.append(f"{pre}nd{d}")
    c.add(f"{pre}model", "\nUNION ALL\n".join(
        f"SELECT CAST(tree AS INTEGER) AS tree, CAST(node AS BIGINT) AS node, CAST(depth AS INTEGER) AS depth, "
        f"CAST(size AS BIGINT) AS size, feature, category, split, CAST(leaf_value AS BIGINT) AS leaf_value FROM {n}"
        for n in node_ctes))
    # scoring: every row walks every tree, feature values carried on the row
    fcols = ", ".join(f"{v} AS f_{k}" for k, v in NUMERIC.items())
    c.add(f"{pre}fw", f"SELECT transaction_id, {fcols}, {', '.join(CATEGORICAL)} FROM {pre}fl")
    number = "CASE m.feature " + " ".join(f"WHEN {q(k)} THEN w.f_{k}" for k in NUMERIC) + " END"
    value = "CASE m.feature " + " ".join(f"WHEN {q(k)} THEN w.{k}" for k in CATEGORICAL) + " END"
    goes_left = (f"CASE WHEN m.category IS NULL THEN {number} < m.split "
                 f"ELSE {value} IS DISTINCT FROM m.category END")
    c.add(f"{pre}pw0", f"SELECT w.*, tt.tree, CAST(1 AS BIGINT) AS node FROM {pre}fw w "
                       f"CROSS JOIN (SELECT DISTINCT tree FROM {pre}model) tt")
    for k in range(max_levels):
        c.add(f"{pre}pw{k + 1}", f"""
SELECT w.* EXCLUDE (node),
       CASE WHEN m.feature IS NULL THEN w.node WHEN {goes_left} THEN 2 * w.node ELSE 2 * w.node + 1 END AS node
FROM {pre}pw{k} w JOIN {pre}model m ON m.tree = w.tree AND m.node = w.node""")
    c.add(f"{pre}ps", f"""
SELECT w.transaction_id, CAST(sum(m.leaf_value) AS BIGINT) AS path_sum
FROM {pre}pw{max_levels} w JOIN {pre}model m ON m.tree = w.tree AND m.node = w.node
GROUP BY w.transaction_id""")
    c.add(f"{pre}iso", f"""
SELECT transaction_id, path_sum,
       pow(2.0{D}, -((CAST(path_sum AS DOUBLE) / {FIXED}.0{D}) / {t}.0{D}) / {c_factor_sql('(SELECT psi_eff FROM ' + pre + 'fpar)')}) AS iso_score
FROM {pre}ps""")
    c.add(f"{pre}rk", f"""
SELECT transaction_id, path_sum, row_number() OVER (ORDER BY path_sum, transaction_id) - 1 AS r FROM {pre}iso""")
    pos = f"({p.contamination}{D} * CAST(n - 1 AS DOUBLE))"
    c.add(f"{pre}thr", f"""
SELECT floor({pos}) AS lo, {pos} - floor({pos}) AS frac,
       (SELECT path_sum FROM {pre}rk WHERE r = floor({pos})) AS v_lo,
       (SELECT path_sum FROM {pre}rk WHERE r = least(floor({pos}) + 1, n - 1)) AS v_hi
FROM {pre}nrows""")
    c.add(f"{pre}ml", f"""
SELECT i.transaction_id, i.path_sum, i.iso_score,
       {half_even(f"CASE WHEN mm.smax = mm.smin THEN 0.0{D} ELSE (i.iso_score - mm.smin) / (mm.smax - mm.smin) END", 4)}
         AS ml_anomaly_score,
       CASE WHEN i.path_sum < t.v_lo OR (t.frac > 0 AND t.v_hi > t.v_lo AND i.path_sum = t.v_lo)
            THEN 'anomaly' ELSE 'normal' END AS ml_flag
FROM {pre}iso i CROSS JOIN (SELECT min(iso_score) AS smin, max(iso_score) AS smax FROM {pre}iso) mm
CROSS JOIN {pre}thr t""")


def risk(c: Chain, pre: str, p: Params = P) -> None:
    c.add(f"{pre}risk", f"""
SELECT f.*, m.path_sum, m.iso_score, coalesce(m.ml_anomaly_score, 0.0{D}) AS ml_anomaly_score, m.ml_flag,
       {half_even(f"{p.rule_weight}{D} * f.rule_severity + {p.ml_weight}{D} * coalesce(m.ml_anomaly_score, 0.0{D})", 4)}
         AS risk_score
FROM {pre}fl f LEFT JOIN {pre}ml m ON f.transaction_id = m.transaction_id""")
    c.add(f"{pre}riskl", f"""
SELECT * EXCLUDE (vendor_n), vendor_n AS vendor_frequency,
       CASE WHEN risk_score > {p.high_cut}{D} THEN 'High' WHEN risk_score > {p.medium_cut}{D} THEN 'Medium'
            ELSE 'Low' END AS risk_level
FROM {pre}risk""")
    c.add(f"{pre}val", f"""
SELECT r.*, coalesce(l.is_anomaly, 0) AS is_anomaly, coalesce(l.anomaly_type, 'none') AS anomaly_type,
       r.risk_level IN ('High', 'Medium') AS is_flagged
FROM {pre}riskl r LEFT JOIN positives l ON r.transaction_id = l.transaction_id""")


# ---------------------------------------------------------------- chains

def main_chain(upto: str = "val") -> Chain:
    c = Chain()
    lineitem_ledger(c, "base")
    planted(c, "base")
    clean(c, "ledger", "m_")
    if upto == "clean":
        return c
    enrich_rules(c, "m_")
    if upto == "rules":
        return c
    features(c, "m_")
    forest(c, "m_")
    risk(c, "m_")
    return c


def events_chain(upto: str = "rules") -> Chain:
    c = Chain()
    events_ledger(c, "ev_base")
    clean(c, "ev_base", "e_")
    if upto == "clean":
        return c
    enrich_rules(c, "e_")
    return c
