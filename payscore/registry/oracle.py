"""The same results in plain SQL, written independently of the DataFrame code.

Every statement is put together from named subqueries; row ids are unique in the example
transactions, so ``id`` stands for a row.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from payscore import fixtures as fx
from payscore.operators.report import DISPLAY_COLUMNS


def q(text: object) -> str:
    return "'" + str(text).replace("'", "''") + "'"


def values(rows: Sequence[Sequence[object]]) -> str:
    def one(v: object) -> str:
        return q(v) if isinstance(v, str) else repr(v)

    return "VALUES " + ", ".join("(" + ", ".join(one(v) for v in row) + ")" for row in rows)


def ranges(rows) -> str:
    return f"ranges(ord, fcode, flag, lo, hi, code, descr) AS ({values(rows)})"


TX = f"tx AS MATERIALIZED ({fx.TRANSACTIONS_SQL})"
RANGES = ranges(fx.RANGES)
FEATS = f"feats(idx, col_name, pcode, descr, feature_flag, model_flag) AS ({values(fx.FEATURES)})"


def bucket(value: str, missing: str, flag: str) -> str:
    return (
        f"CASE WHEN {missing} THEN '9999' ELSE coalesce((SELECT arg_max(r.code, r.ord) FROM ranges r "
        f"WHERE r.flag = '{flag}' AND {value} > r.lo AND {value} <= r.hi), '0') END"
    )


FACTS = "(bankacc_id_type = 'I' AND length(bankacc_id_no) IN (15, 18))"
REGION = f"CASE WHEN {FACTS} THEN substr(bankacc_id_no, 1, 6) ELSE '111111' END"
SEX = (
    f"CASE WHEN {FACTS} THEN coalesce(CAST(try_cast(substr(bankacc_id_no, length(bankacc_id_no) - 1, 1) "
    "AS INT) % 2 AS VARCHAR), '1') ELSE '1' END"
)
AGE = (
    f"CASE WHEN {FACTS} THEN coalesce(CAST({fx.AS_OF_YEAR} - try_cast(CASE WHEN length(bankacc_id_no) = 15 THEN "
    "'19' || substr(bankacc_id_no, 7, 2) ELSE substr(bankacc_id_no, 7, 4) END AS INT) AS VARCHAR), '1') ELSE '1' END"
)
NO_AMOUNT = "(trans_amnt IS NULL OR trans_amnt IN ('', 'null'))"
AMOUNT = "try_cast(trans_amnt AS DOUBLE)"

ATTR = f"""attr AS MATERIALIZED (SELECT *, {SEX} AS acc_cust_sex, {REGION} AS acc_cust_home, {AGE} AS acc_cust_age,
 '0' AS acc_cust_instancetype, '1' AS acount_time_rang,
 CAST(month(CAST(plnmio_date AS DATE)) AS VARCHAR) AS acc_cust_month,
 CAST(day(CAST(plnmio_date AS DATE)) AS VARCHAR) AS acc_cust_day, {AMOUNT} AS amount FROM tx)"""
CUST = f"""cust AS MATERIALIZED (SELECT *, {bucket("amount", NO_AMOUNT, "amnt_rang")} AS acc_cust_amntrang,
 {bucket("CAST(acc_cust_age AS DOUBLE)", "FALSE", "age_rang")} AS acc_cust_agerang,
 {bucket("CAST(acc_cust_day AS DOUBLE)", "FALSE", "date_rang")} AS acc_cust_dayrang FROM attr)"""
BASE = [TX, RANGES, ATTR, CUST]


def sql(ctes: Sequence[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


# Features, catalog, portraits


def feature_rows(source: str, features: Sequence[fx.Feature], key: str = "mios_trans_code") -> str:
    return " UNION ALL ".join(
        f"SELECT {key} AS id, '{f.pcode}' AS pcode, CASE WHEN {f.col_name} IS NULL OR {f.col_name} = '' "
        f"THEN '0' ELSE {f.col_name} END AS value FROM {source}"
        for f in features
    )


ACTIVE = [f for f in fx.FEATURES if f.feature_flag == 1]
MONTH = [f for f in ACTIVE if f.model_flag != 2]
YEAR = [f for f in ACTIVE if f.model_flag != 1]

VALS = f"vals AS MATERIALIZED (SELECT DISTINCT pcode, value FROM ({feature_rows('cust', ACTIVE)}))"


def catalog(name: str, vals: str) -> str:
    return f"""{name} AS MATERIALIZED (
 SELECT CAST(row_number() OVER (ORDER BY f.idx, v.value) AS VARCHAR) AS feature_id,
  CAST(CAST(f.pcode AS INT) + row_number() OVER (PARTITION BY f.pcode ORDER BY v.value) AS VARCHAR) AS feature_code,
  v.value AS feature_value, v.value AS feature_name, f.pcode AS feature_pcode, f.descr AS feature_ptype,
  coalesce((SELECT arg_min(r.descr, r.ord) FROM ranges r WHERE r.fcode = f.pcode AND r.code = v.value), v.value)
   AS feature_desc, '1' AS feature_weight
 FROM {vals} v JOIN feats f ON f.pcode = v.pcode)"""


CATALOG = [*BASE, FEATS, VALS, catalog("cat", "vals")]


def portrait(name: str, source: str, features: Sequence[fx.Feature]) -> str:
    return f"""{name} AS MATERIALIZED (SELECT r.id, string_agg(c.feature_code, '_' ORDER BY c.feature_code) AS features
 FROM ({feature_rows(source, features)}) r JOIN cat c ON c.feature_pcode = r.pcode AND c.feature_value = r.value
 GROUP BY r.id)"""


# Model inputs: rows(id, model, label, w, train), terms(id, slot, code)

CODES = {
    "FEATURE1": "'a' || acc_cust_amntrang",
    "FEATURE2": "'b' || bank_code",
    "FEATURE3": "'c' || mio_class",
    "FEATURE4": "'d' || acc_cust_dayrang",
}
LABEL = "CASE WHEN try_cast(trans_stat AS DOUBLE) = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
LABEL3 = "CASE order_status WHEN 'F' THEN 0.0::DOUBLE WHEN 'O' THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END"
TERMS = "terms AS MATERIALIZED (" + " UNION ALL ".join(
    f"SELECT mios_trans_code AS id, '{s}' AS slot, {e} AS code FROM cust" for s, e in CODES.items()
) + ")"


def rows(label: str = LABEL, weight: str = "1.0", model: str = "''") -> str:
    return (
        f"rows AS MATERIALIZED (SELECT mios_trans_code AS id, CAST({model} AS VARCHAR) AS model, {label} AS label, "
        f"CAST({weight} AS DOUBLE) AS w, TRUE AS train FROM cust)"
    )


def levels() -> list[str]:
    return [
        "lev AS MATERIALIZED (SELECT DISTINCT r.model, t.slot, t.code FROM rows r JOIN terms t ON t.id = r.id)",
        "size AS MATERIALIZED (SELECT model, count(*) AS d FROM lev GROUP BY model)",
        "lab AS MATERIALIZED (SELECT DISTINCT label FROM rows WHERE train)",
        "cc AS MATERIALIZED (SELECT model, label, CAST(count(*) AS DOUBLE) AS k FROM rows WHERE train GROUP BY model, label)",
        "cw AS MATERIALIZED (SELECT model, label, CASE WHEN count(*) OVER (PARTITION BY model) = 2 "
        "THEN 1 - k / sum(k) OVER (PARTITION BY model) ELSE ((sum(k) OVER (PARTITION BY model) - k) / k) / "
        "sum((tot - k) / k) OVER (PARTITION BY model) END AS v FROM "
        "(SELECT *, sum(k) OVER (PARTITION BY model) AS tot FROM cc))",
    ]


def nb(r: int, lam: float, extra: str, bernoulli: bool = False) -> list[str]:
    """Prior and theta of round r from the weights in w{r}(id, model, label, w)."""
    denominator = f"n.n + 2 * {lam}" if bernoulli else f"n.a + z.d * {lam}"
    return [
        f"n{r} AS MATERIALIZED (SELECT w.model, w.label, sum(w.w) AS n, sum(w.w * x.m) AS a FROM w{r} w "
        "JOIN (SELECT id, count(*) AS m FROM terms GROUP BY id) x ON x.id = w.id GROUP BY w.model, w.label)",
        f"prior{r} AS MATERIALIZED (SELECT n.model, n.label, ln(n.n + {lam}) - ln(sum(n.n) OVER (PARTITION BY n.model) "
        f"+ count(*) OVER (PARTITION BY n.model) * {lam}) + {extra} AS v FROM n{r} n "
        "JOIN cw ON cw.model = n.model AND cw.label = n.label)",
        f"sums{r} AS MATERIALIZED (SELECT w.model, w.label, t.slot, t.code, sum(w.w) AS s FROM w{r} w "
        "JOIN terms t ON t.id = w.id GROUP BY ALL)",
        f"theta{r} AS MATERIALIZED (SELECT l.model, n.label, l.slot, l.code, "
        f"ln(coalesce(s.s, 0) + {lam}) - ln({denominator}) AS v "
        f"FROM lev l JOIN n{r} n ON n.model = l.model JOIN size z ON z.model = l.model LEFT JOIN sums{r} s "
        "ON s.model = l.model AND s.label = n.label AND s.slot = l.slot AND s.code = l.code)",
    ]


def score(r: int, source: str = "rows", own: bool = True) -> list[str]:
    """Log joint scores of round r: with ``own`` by the row's model, else by every model."""
    match = "AND h.model = r.model" if own else ""
    return [
        f"score{r} AS MATERIALIZED (SELECT p.id, p.model, p.label, p.v + coalesce(s.v, 0) AS v FROM "
        f"(SELECT r.id, h.model, h.label, h.v FROM {source} r JOIN prior{r} h ON TRUE {match}) p LEFT JOIN "
        f"(SELECT r.id, h.model, h.label, sum(h.v) AS v FROM {source} r JOIN terms t ON t.id = r.id "
        f"JOIN theta{r} h ON h.slot = t.slot AND h.code = t.code {match} GROUP BY ALL) s "
        "ON s.id = p.id AND s.model = p.model AND s.label = p.label)",
        f"pred{r} AS MATERIALIZED (SELECT id, model, label AS pred FROM score{r} QUALIFY row_number() OVER "
        "(PARTITION BY id, model ORDER BY v DESC, label) = 1)",
    ]


def fit(
    kind: str = "multinomial", lam: float = 1.0, extra: str = "ln(cw.v)"
) -> list[str]:
    first = "w0 AS MATERIALIZED (SELECT id, model, label, w FROM rows WHERE train)"
    return [*levels(), first, *nb(0, lam, extra, kind == "bernoulli")]


def boost(rounds: int, alpha: str = "half_log", lam: float = 1.0) -> list[str]:
    """Unrolled rounds: prior, theta, step{r}(model, e, alpha)."""
    out = fit(lam=lam)
    for r in range(rounds):
        out += [
            c.replace(f"score{r} ", f"fscore{r} ").replace(f"pred{r} ", f"fpred{r} ")
            for c in score(r, f"w{r}")
        ]
        e = "greatest(least(e, 1 - 1e-10), 1e-10)"
        size = "(SELECT count(*) FROM lab)"
        a = f"0.5 * ln((1 - {e}) / {e})" if alpha == "half_log" else f"ln(({size} - 1) * (1 - {e}) / {e})"
        out.append(
            f"step{r} AS MATERIALIZED (SELECT model, {e} AS e, {a} AS alpha FROM (SELECT w.model, "
            f"sum(CASE WHEN p.pred <> w.label THEN w.w ELSE 0 END) / count(*) AS e FROM w{r} w "
            f"JOIN fpred{r} p ON p.id = w.id GROUP BY w.model))"
        )
        if r + 1 < rounds:
            grown = "w.w * CASE WHEN p.pred <> w.label THEN exp(s.alpha) ELSE 1 END"
            out.append(
                f"w{r + 1} AS MATERIALIZED (SELECT id, model, label, g * count(*) OVER (PARTITION BY model) / "
                f"sum(g) OVER (PARTITION BY model) AS w FROM (SELECT w.id, w.model, w.label, {grown} AS g "
                f"FROM w{r} w JOIN fpred{r} p ON p.id = w.id JOIN step{r} s ON s.model = w.model))"
            )
            out += nb(r + 1, lam, "ln(cw.v)")
    return out


def softmax(name: str, source: str, value: str, by: str) -> str:
    """name(by, label, p): shares of exp(value) within by."""
    return (
        f"{name} AS MATERIALIZED (SELECT {by}, label, g / sum(g) OVER (PARTITION BY {by}) AS p FROM (SELECT *, "
        f"exp({value} - max({value}) OVER (PARTITION BY {by})) AS g FROM {source}))"
    )


def flat_model(rounds: int, columns: str) -> str:
    parts = []
    for r in range(rounds):
        parts.append(
            f"SELECT {columns}, label, '' AS slot, '' AS code, round(v, 6) AS value FROM prior{r} UNION ALL "
            f"SELECT {columns}, label, slot, code, round(v, 6) AS value FROM theta{r}"
        )
    return " UNION ALL ".join(parts)


def pick(raw: str, prob: str, thresholds: Sequence[float] | None = None, more: str = "", extra: str = "") -> str:
    """id, prediction, both raw scores and p1 from raw(id, label, v) and prob(id, label, p)."""
    rank = "a.v DESC" if thresholds is None else (
        f"b.p / CASE WHEN a.label = 0 THEN {thresholds[0]} ELSE {thresholds[1]} END DESC"
    )
    return (
        f"SELECT id AS mios_trans_code, min(CASE WHEN k = 1 THEN label END) AS prediction, "
        "round(sum(CASE WHEN label = 0 THEN v ELSE 0 END), 6) AS raw0, "
        "round(sum(CASE WHEN label = 1 THEN v ELSE 0 END), 6) AS raw1, "
        f"round(sum(CASE WHEN label = 1 THEN p ELSE 0 END), 6) AS p1 {more} FROM (SELECT a.id, a.label, a.v, b.p, "
        f"row_number() OVER (PARTITION BY a.id ORDER BY {rank}, a.label) AS k FROM {raw} a "
        f"JOIN {prob} b ON b.id = a.id AND b.label = a.label) {extra} GROUP BY id"
    )


def round_votes(rounds: int) -> list[str]:
    """raw(id, label, v): steps voted by the rounds."""
    union = " UNION ALL ".join(
        f"SELECT p.id, p.pred, s.alpha FROM pred{r} p JOIN step{r} s ON s.model = p.model" for r in range(rounds)
    )
    return [
        f"ballots AS MATERIALIZED ({union})",
        "raw AS MATERIALIZED (SELECT i.id, l.label, coalesce(sum(b.alpha), 0) AS v FROM rows i JOIN lab l ON TRUE "
        "LEFT JOIN ballots b ON b.id = i.id AND b.pred = l.label GROUP BY i.id, l.label)",
        softmax("prob", "raw", "v", "id"),
    ]


def boosted(rounds: int) -> list[str]:
    out = boost(rounds)
    for r in range(rounds):
        out += score(r)
    return out + round_votes(rounds)


def month_weights_sql(n: int, now: int) -> list[float]:
    """Stated once more from the rule: 3/12 now, 2/12 beside it, nine shares of what is left."""
    if n != 12:
        return [1.0 / n] * n
    rest = (1.0 - 3.0 / 12 - (1 if now == 12 else 2) * (2.0 / 12)) / 9
    return [{0: 3.0 / 12, 1: 2.0 / 12}.get(abs(m - now), rest) for m in range(1, 13)]


def ensemble(rounds: int, vote: str, prob: str | None, weights: Sequence[float], source: str) -> list[str]:
    """Year scores of the rows in ``source``(id): yraw(id, label, v), yprob(…, p), blend(…, p).

    Votes are sums of equal numbers in any order, so ties are told by 12 digits.
    """
    out = ["mw AS (SELECT model, CAST(v AS DOUBLE) AS v FROM "
           f"({values([(str(i + 1), x) for i, x in enumerate(weights)])}) AS t(model, v))"]
    for r in range(rounds):
        out += score(r, source, own=False)
    every = " UNION ALL ".join(f"SELECT id, model, label, {r} AS rnd, v FROM score{r}" for r in range(rounds))
    out.append(f"joint AS MATERIALIZED ({every})")
    if vote == "joint":
        out.append("month_raw AS MATERIALIZED (SELECT id, model, label, sum(v) AS v FROM joint GROUP BY ALL)")
    else:
        union = " UNION ALL ".join(
            f"SELECT p.id, p.model, p.pred AS label, s.alpha AS v FROM pred{r} p JOIN step{r} s ON s.model = p.model"
            for r in range(rounds)
        )
        out.append(
            "month_raw AS MATERIALIZED (SELECT j.id, j.model, j.label, coalesce(b.v, 0) AS v FROM "
            "(SELECT DISTINCT id, model, label FROM joint) j LEFT JOIN (SELECT id, model, label, sum(v) AS v FROM "
            f"({union}) GROUP BY ALL) b ON b.id = j.id AND b.model = j.model AND b.label = j.label)"
        )
    out += [
        "month_win AS MATERIALIZED (SELECT id, model, label FROM month_raw QUALIFY row_number() OVER "
        "(PARTITION BY id, model ORDER BY v DESC, label) = 1)",
        "yraw AS MATERIALIZED (SELECT i.id, l.label, coalesce(sum(m.v), 0) AS v FROM "
        f"{source} i JOIN lab l ON TRUE LEFT JOIN month_win w ON w.id = i.id AND w.label = l.label "
        "LEFT JOIN mw m ON m.model = w.model GROUP BY i.id, l.label)",
        softmax("yprob", "yraw", "v", "id"),
    ]
    if prob == "blend":
        steps = " UNION ALL ".join(f"SELECT model, {r} AS rnd, alpha FROM step{r}" for r in range(rounds))
        out += [
            softmax("post", "joint", "v", "id, model, rnd"),
            f"rw AS (SELECT model, rnd, exp(alpha) / sum(exp(alpha)) OVER (PARTITION BY model) AS v FROM ({steps}))",
            "month_mix AS MATERIALIZED (SELECT p.id, p.model, p.label, sum(p.p * w.v) AS v FROM post p "
            "JOIN rw w ON w.model = p.model AND w.rnd = p.rnd GROUP BY ALL)",
            softmax("month_prob", "month_mix", "v", "id, model"),
            "sw AS (SELECT model, exp(v) / sum(exp(v)) OVER () AS v FROM mw)",
            "blend AS MATERIALIZED (SELECT p.id, p.label, sum(p.p * w.v) AS p FROM month_prob p "
            "JOIN sw w ON w.model = p.model GROUP BY ALL)",
        ]
    elif prob == "mean":
        out += [
            softmax("post", "joint", "v", "id, model"),
            "blend AS MATERIALIZED (SELECT p.id, p.label, sum(p.p * w.v) AS p FROM post p "
            "JOIN mw w ON w.model = p.model GROUP BY ALL)",
        ]
    return out


def year(rounds: int, vote: str, prob: str | None) -> str:
    ctes = [*BASE, TERMS, rows(model="month_id")]
    ctes += fit() if rounds == 1 else boost(rounds)
    weights = [1.0 / 12] * 12 if rounds == 1 else month_weights_sql(12, fx.CURRENT_MONTH)
    ctes += ensemble(rounds, vote, prob, weights, "rows")
    more = ", round(sum(CASE WHEN y.label = 1 THEN b.p ELSE 0 END), 6) AS prob1, " \
        "round(sum(CASE WHEN k = 1 THEN b.p ELSE 0 END), 6) AS confidence" if prob else ""
    join = "JOIN blend b ON b.id = y.id AND b.label = y.label" if prob else ""
    return sql(ctes, f"""SELECT y.id AS mios_trans_code, min(CASE WHEN k = 1 THEN y.label END) AS prediction,
 round(sum(CASE WHEN y.label = 1 THEN y.v ELSE 0 END), 6) AS votes1,
 round(sum(CASE WHEN y.label = 1 THEN y.p ELSE 0 END), 6) AS p1 {more}
 FROM (SELECT a.id, a.label, a.v, p.p, row_number() OVER (PARTITION BY a.id ORDER BY round(a.v, 12) DESC, a.label) AS k
  FROM yraw a JOIN yprob p ON p.id = a.id AND p.label = a.label) y {join} GROUP BY y.id""")


NB = [*BASE, TERMS, rows(), *fit(), *score(0), softmax("prob0", "score0", "v", "id")]
PREDICTED = "SELECT r.id, r.label, p.pred FROM rows r JOIN pred0 p ON p.id = r.id"


def metric_row(label: str, pred: str, published: str) -> str:
    return f"""SELECT {published} AS as_published, CAST(max(n) AS BIGINT) AS n_rows,
 CAST(sum(tp) AS BIGINT) AS n_correct, round(sum(tp) / max(n), 6) AS accuracy,
 round(sum(sup / n * prec), 6) AS precision, round(sum(sup / n * rec), 6) AS recall,
 round(sum(sup / n * CASE WHEN prec + rec = 0 THEN 0 ELSE 2 * prec * rec / (prec + rec) END), 6) AS f1,
 round(sum(sup / n * CASE WHEN n = sup THEN 0 ELSE (prd - tp) / (n - sup) END), 6) AS fpr,
 round((max(rec) FILTER (c = 1) + 1 - max((prd - tp) / (n - sup)) FILTER (c = 1)) / 2, 6) AS area_under_roc,
 round(max(rec * prec + (1 - rec) * (prec + sup / n) / 2) FILTER (c = 1), 6) AS area_under_pr
 FROM (SELECT *, CASE WHEN prd = 0 THEN 0 ELSE tp / prd END AS prec, tp / sup AS rec FROM
  (SELECT l.label AS c, CAST((SELECT count(*) FROM done) AS DOUBLE) AS n,
   CAST((SELECT count(*) FROM done d WHERE d.{label} = l.label) AS DOUBLE) AS sup,
   CAST((SELECT count(*) FROM done d WHERE d.{pred} = l.label) AS DOUBLE) AS prd,
   CAST((SELECT count(*) FROM done d WHERE d.{label} = l.label AND d.{pred} = l.label) AS DOUBLE) AS tp FROM lab l))"""


PART = "CASE WHEN CAST('0x' || substr(md5(trans_code || '|' || trans_bat_no), 1, 8) AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END"
NEAREST = "CAST(list_position(dist, list_min(dist)) - 1 AS VARCHAR)"
DIST = "[" + ", ".join(
    " + ".join(
        f"power(CAST({c} AS DOUBLE) - {x}, 2)"
        for c, x in zip(("acc_cust_amntrang", "acc_cust_sex", "acc_cust_agerang", "acc_cust_dayrang"), center)
    )
    for center in fx.CENTERS
) + "] AS dist"
STAGED = "mios_trans_code, trans_code, trans_bat_no, trans_stat, bankacc_id_no, trans_amnt"

POINT = ("acc_cust_amntrang", "acc_cust_sex", "acc_cust_agerang", "acc_cust_dayrang")
XS = [f"x{d}" for d in range(len(POINT))]


def bisected(source: str, where: str = "TRUE", updates: int = 20) -> list[str]:
    """leaves(node, side centers) of a clustering of 4: two levels of splits, each refined ``updates`` times.

    places(id, cluster) has the cluster of every row of ``source``.
    """
    coords = ", ".join(f"coalesce(try_cast({c} AS DOUBLE), 0) AS {x}" for c, x in zip(POINT, XS))
    both = ", ".join(f"sum(cnt * {x}) / sum(cnt) AS {x}" for x in XS)

    def distance(side: str) -> str:
        return " + ".join(f"(p.{x} - {side}.{x}) * (p.{x} - {side}.{x})" for x in XS)

    def nearer(points: str, centers: str) -> str:
        return (
            f"SELECT p.*, CASE WHEN {distance('l')} <= {distance('r')} THEN 'L' ELSE 'R' END AS side FROM {points} p "
            f"JOIN {centers} l ON l.node = p.node AND l.side = 'L' JOIN {centers} r ON r.node = p.node AND r.side = 'R'"
        )

    out = [
        f"at_all AS MATERIALIZED (SELECT mios_trans_code AS id, {coords}, '' AS node FROM {source})",
        f"p0 AS MATERIALIZED (SELECT {', '.join(XS)}, '' AS node, count(*) AS cnt FROM (SELECT {coords} FROM {source} WHERE {where}) GROUP BY ALL)",
    ]
    points = "at_all"
    for level in (0, 1):
        spread = ", ".join(f"sum(cnt) * sum(cnt * {x} * {x}) - sum(cnt * {x}) * sum(cnt * {x}) AS v{d}" for d, x in enumerate(XS))
        first = " ".join(
            f"WHEN {' AND '.join(f'v{d} >= v{e}' for e in range(len(XS)))} THEN p.{x} <= w.{x}" for d, x in enumerate(XS)
        )
        out += [
            f"w{level} AS MATERIALIZED (SELECT node, {both}, {spread} FROM p{level} GROUP BY node)",
            f"c{level}_0 AS MATERIALIZED (SELECT node, side, {both} FROM (SELECT p.*, CASE WHEN CASE {first} END THEN 'L' "
            f"ELSE 'R' END AS side FROM p{level} p JOIN w{level} w ON w.node = p.node) GROUP BY node, side)",
        ]
        for i in range(updates):
            out.append(
                f"c{level}_{i + 1} AS MATERIALIZED (SELECT node, side, {both} FROM ({nearer(f'p{level}', f'c{level}_{i}')}) "
                "GROUP BY node, side)"
            )
        ends, last = f"c{level}_{updates}", level + 1
        columns = ", ".join(XS)
        out += [
            f"p{last} AS MATERIALIZED (SELECT {columns}, node || side AS node, cnt FROM ({nearer(f'p{level}', ends)}))",
            f"at{last} AS MATERIALIZED (SELECT id, {columns}, node || side AS node FROM ({nearer(points, ends)}))",
        ]
        points = f"at{last}"
    number = "CASE node WHEN 'LL' THEN '0' WHEN 'LR' THEN '1' WHEN 'RL' THEN '2' ELSE '3' END"
    out += [
        f"places AS MATERIALIZED (SELECT id, {number} AS cluster FROM at2)",
        f"leaves AS MATERIALIZED (SELECT cluster, sum(p.cnt)::BIGINT AS n_rows, sum(p.cnt * ({distance('c')})) AS cost, "
        + ", ".join(f"any_value(c.{x}) AS {x}" for x in XS)
        + f" FROM (SELECT *, {number} AS cluster FROM p2) p JOIN c1_{updates} c ON c.node || c.side = p.node GROUP BY cluster)",
    ]
    return out


FREQ = (
    "freq AS MATERIALIZED (SELECT bankacc_id_type AS t, bankacc_id_no AS n, trans_stat AS s, count(*) AS kk_cnt FROM cust "
    "GROUP BY ALL)"
)
FULL = f"""full_cust AS MATERIALIZED (SELECT c.*, {NEAREST} AS acc_cust_km, f.kk_cnt FROM (SELECT *, {DIST} FROM cust) c
 LEFT JOIN freq f ON f.t = c.bankacc_id_type AND f.n = c.bankacc_id_no AND f.s = c.trans_stat)"""
MONTH_ROWS = """kept AS MATERIALIZED (SELECT * FROM cust WHERE mios_trans_code IN (SELECT min(mios_trans_code) FROM cust
 GROUP BY trans_stat, bankacc_id_type, bankacc_id_no))"""


def split_terms(source: str) -> str:
    """One term per code of a portrait; the slot is the feature the code belongs to."""
    return (
        f"terms AS MATERIALIZED (SELECT p.id, c.feature_pcode AS slot, c.feature_code AS code FROM "
        f"(SELECT id, unnest(string_split(features, '_')) AS code FROM {source}) p "
        "JOIN cat c ON c.feature_code = p.code)"
    )


def month_training(rounds: int) -> list[str]:
    return [*CATALOG, FREQ, FULL, *month_rows(rounds)]


def month_rows(rounds: int) -> list[str]:
    return [
        MONTH_ROWS,
        portrait("pho", "cust", MONTH),
        split_terms("pho"),
        f"rows AS MATERIALIZED (SELECT mios_trans_code AS id, '' AS model, {LABEL} AS label, 1.0::DOUBLE AS w, "
        f"{PART} = 'train' AS train FROM kept)",
        *boost(rounds),
    ]


def round_scores_of(rounds: int, source: str) -> list[str]:
    out = []
    for r in range(rounds):
        out += score(r, source)
    votes = round_votes(rounds)
    votes[1] = votes[1].replace("FROM rows i", f"FROM {source} i")
    return out + votes


WINNER = (
    "win AS MATERIALIZED (SELECT a.id, a.label, b.p FROM raw a JOIN prob b ON b.id = a.id AND b.label = a.label "
    "QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY a.v DESC, a.label) = 1)"
)


BY_MONTH = f"""rows AS MATERIALIZED (SELECT mios_trans_code AS id, acc_cust_month AS model, {LABEL} AS label,
 1.0::DOUBLE AS w, {PART} = 'train' AS train FROM cust WHERE mios_trans_code IN (SELECT min(mios_trans_code) FROM cust
 GROUP BY acc_cust_month, trans_stat, bankacc_id_type, bankacc_id_no))"""
YEAR_ROWS = f"""yrows AS MATERIALIZED (SELECT c.mios_trans_code AS id, '' AS model, {PART} AS part, {LABEL} AS label
 FROM cust c RIGHT JOIN (SELECT min(mios_trans_code) AS code, acc_cust_month AS m FROM cust
  GROUP BY trans_stat, bankacc_id_type, bankacc_id_no, acc_cust_month) g
 ON c.mios_trans_code = g.code AND c.acc_cust_month = g.m)"""
YEAR_WINNER = """ywin AS MATERIALIZED (SELECT id, label FROM yraw QUALIFY row_number() OVER
  (PARTITION BY id ORDER BY round(v, 12) DESC, label) = 1)"""


def year_training() -> list[str]:
    return [
        *CATALOG, portrait("pho", "cust", MONTH), renamed(split_terms("pho"), {"terms": "month_terms"}), BY_MONTH,
        *[renamed(c, {"terms": "month_terms"}) for c in boost(2)],
        portrait("ypho", "cust", YEAR), split_terms("ypho"), YEAR_ROWS,
        *ensemble(2, "joint", "blend", month_weights_sql(12, fx.CURRENT_MONTH), "yrows"), YEAR_WINNER,
    ]


def year_job(test_only: bool) -> str:
    here = "r.part = 'test'" if test_only else "TRUE"
    return sql(year_training(), f"""SELECT r.id AS mios_trans_code, p.features, CASE WHEN {here} THEN y.label END AS train_label,
 CASE WHEN {here} THEN round(round(b.p * 100, 2), 6) END AS train_accuracy
 FROM yrows r JOIN ypho p ON p.id = r.id JOIN ywin y ON y.id = r.id JOIN blend b ON b.id = r.id AND b.label = y.label""")


# Later batches, scored with what was learned from cust: bcust(…), cat2(…)


def renamed(text: str, names: Mapping[str, str]) -> str:
    return re.sub(r"\b(" + "|".join(names) + r")\b", lambda m: names[m[0]], text)


def two_batches(training: str) -> list[str]:
    """cust has the rows to learn from, bcust all others; cat2 extends cat by the values of bcust."""
    batch = {"tx": "batch", "attr": "battr", "cust": "bcust"}
    days = bucket("CAST(acc_cust_day AS DOUBLE)", "FALSE", "date_rang")
    no_days = bucket("CAST(acc_cust_day AS DOUBLE)", "acc_cust_day IS NULL", "date_rang")
    assert days in CUST
    changed = ", ".join(f"{e} AS {c}" for c, e in fx.LATER_SQL.items())
    return [
        TX, RANGES, FEATS,
        f"src AS MATERIALIZED (SELECT * FROM tx WHERE {training})",
        renamed(ATTR, {"tx": "src"}), CUST, VALS, catalog("cat", "vals"),
        f"batch AS MATERIALIZED (SELECT * REPLACE ({changed}) FROM tx WHERE NOT ({training}))",
        renamed(ATTR, batch), renamed(CUST.replace(days, no_days), batch),
        f"newvals AS (SELECT DISTINCT pcode, value FROM ({feature_rows('bcust', ACTIVE)}) EXCEPT SELECT pcode, value FROM vals)",
        catalog("new", "newvals"),
        "cat2 AS MATERIALIZED (SELECT feature_code, feature_value, feature_pcode FROM cat UNION ALL SELECT "
        "CAST(CAST(feature_code AS INT) + (SELECT count(*) FROM cat o WHERE o.feature_pcode = n.feature_pcode) AS VARCHAR), "
        "feature_value, feature_pcode FROM new n)",
    ]


def positions(chosen: str) -> list[str]:
    """idx(slot, code, width, idx, pos) of the (slot, code) rows chosen."""
    return [
        f"chosen AS ({chosen})",
        "cnts AS (SELECT slot, code, count(*) AS cnt FROM chosen GROUP BY slot, code)",
        "idx AS MATERIALIZED (SELECT slot, code, CAST(row_number() OVER (PARTITION BY slot ORDER BY cnt DESC, code) - 1 AS INT) "
        "AS idx, CAST(count(*) OVER (PARTITION BY slot) AS INT) AS width, "
        "CAST(row_number() OVER (ORDER BY slot, cnt DESC, code) - 1 AS INT) AS pos FROM cnts)",
    ]


def ones(terms: str) -> str:
    return (
        "ones AS MATERIALIZED (SELECT t.id, coalesce(string_agg(CAST(i.pos AS VARCHAR), ',' ORDER BY i.pos), '') AS active "
        f"FROM {terms} t LEFT JOIN idx i ON i.slot = t.slot AND i.code = t.code GROUP BY t.id)"
    )


def unseen_month(training: str) -> str:
    later = {"terms": "bterms", "cat": "cat2"}
    return sql(
        [*two_batches(training), *month_rows(2), *positions("SELECT t.slot, t.code FROM terms t JOIN rows r ON r.id = t.id"),
         renamed(portrait("bpho", "bcust", MONTH), later), renamed(split_terms("bpho"), later),
         "everyone AS MATERIALIZED (SELECT mios_trans_code AS id, '' AS model FROM bcust)",
         *[renamed(c, later) for c in round_scores_of(2, "everyone")], WINNER, ones("bterms")],
        """SELECT p.id AS mios_trans_code, p.features, o.active, w.label AS train_label, round(w.p, 6) AS train_accuracy
 FROM bpho p JOIN win w ON w.id = p.id JOIN ones o ON o.id = p.id""")


def unseen_year(training: str) -> str:
    later = {"cust": "bcust", "cat": "cat2"}
    months = {"terms": "month_terms"}
    return sql(
        [*two_batches(training), portrait("pho", "cust", MONTH), renamed(split_terms("pho"), months), BY_MONTH,
         *[renamed(c, months) for c in boost(2)],
         portrait("tpho", "cust", YEAR), renamed(split_terms("tpho"), {"terms": "tterms"}), renamed(YEAR_ROWS, {"yrows": "trows"}),
         *positions("SELECT t.slot, t.code FROM tterms t JOIN trows r ON r.id = t.id"),
         renamed(portrait("ypho", "cust", YEAR), later), renamed(split_terms("ypho"), later), renamed(YEAR_ROWS, later),
         *ensemble(2, "joint", "blend", month_weights_sql(12, fx.CURRENT_MONTH), "yrows"), YEAR_WINNER, ones("terms")],
        """SELECT r.id AS mios_trans_code, p.features, o.active, y.label AS train_label,
 round(round(b.p * 100, 2), 6) AS train_accuracy FROM yrows r LEFT JOIN ypho p ON p.id = r.id
 LEFT JOIN ones o ON o.id = r.id LEFT JOIN ywin y ON y.id = r.id LEFT JOIN blend b ON b.id = r.id AND b.label = y.label""")


def saved_tables(metrics: str) -> str:
    """Metrics of done(label, pred) and the dictionary of idx, as rows."""
    names = ["n_rows", "n_correct", "accuracy", "precision", "recall", "f1", "fpr", "area_under_roc", "area_under_pr"]
    pairs = ", ".join(f"{{'name': '{n}', 'value': CAST({n} AS DOUBLE)}}" for n in names)
    return f"""SELECT 'metrics' AS part, m.name, '' AS code, '' AS width, m.value FROM
 (SELECT unnest([{pairs}]) AS m FROM ({metrics})) UNION ALL
 SELECT 'dictionary', slot, code, CAST(width AS VARCHAR), CAST(idx AS DOUBLE) FROM idx"""


def display_columns() -> str:
    given = {
        "sys_no": "'S1'", "acc_cust_name": "'N' || bankacc_id_no", "features": "''", "train_label": "''",
        "train_accuracy": "''", "kk_cnt": "''", "acc_cust_km": "''",
    }
    return ", ".join(f"{given[c]} AS {c}" if c in given else c for c in DISPLAY_COLUMNS)


def _statements() -> dict[str, str]:
    out: dict[str, str] = {}
    tx = [TX]
    out["id_attributes"] = sql(tx, f"""SELECT mios_trans_code, {REGION} AS acc_cust_home, {SEX} AS acc_cust_sex,
 {AGE} AS acc_cust_age, '0' AS acc_cust_instancetype, '1' AS acount_time_rang FROM tx""")
    out["date_parts"] = sql(tx, """SELECT mios_trans_code, CAST(month(CAST(plnmio_date AS DATE)) AS INT) AS month,
 CAST(day(CAST(plnmio_date AS DATE)) AS INT) AS day FROM tx""")
    overlap = [TX, ranges([*fx.RANGES, fx.OVERLAP]), ATTR]
    for name, value, missing, flag in (
        ("amount_bucket", "amount", NO_AMOUNT, "amnt_rang"),
        ("age_bucket", "CAST(acc_cust_age AS DOUBLE)", "FALSE", "age_rang"),
        ("day_bucket", "CAST(acc_cust_day AS DOUBLE)", "FALSE", "date_rang"),
    ):
        out[name] = sql(overlap, f"SELECT mios_trans_code, {bucket(value, missing, flag)} AS bucket FROM attr")
    out["bucket_many"] = sql(
        [TX, "ranges AS (SELECT i * 7919 % 2000 AS ord, 200.0::DOUBLE * i AS lo, 200.0::DOUBLE * i + 250 + i % 7 * 40 AS hi, "
         "'c' || i AS code, 'fine' AS flag FROM range(2000) AS t(i))", ATTR],
        f"SELECT mios_trans_code, {bucket('amount', NO_AMOUNT, 'fine')} AS bucket FROM attr")
    out["stage_month"] = sql(tx, f"SELECT {STAGED} FROM tx WHERE year_id = 1997 AND month_id = 5")
    out["stage_year"] = sql(tx, f"SELECT {STAGED} FROM tx WHERE year_id = 1998")
    out["stage_for_scoring"] = sql(
        tx, f"SELECT * REPLACE ('1' AS trans_stat) FROM (SELECT {STAGED} FROM tx WHERE year_id = 1997 AND month_id = 6)"
    )
    out["read_partitions"] = sql(tx, """SELECT part, CAST(year_id AS INT) AS year_id, CAST(month_id AS INT) AS month_id,
 count(*) AS n_rows, min(mios_trans_code) AS first_code FROM (
 SELECT 'month' AS part, * FROM tx WHERE year_id = 1997 AND month_id = 5 UNION ALL
 SELECT 'year' AS part, * FROM tx WHERE year_id = 1998) GROUP BY part, year_id, month_id""")
    out["drop_header_lines"] = """SELECT doc_id, count(*) AS n_lines, CAST(sum(length(value)) AS BIGINT) AS n_chars FROM
 (SELECT doc_id, unnest(string_split(text, chr(10))) AS value FROM documents)
 WHERE value NOT LIKE '%License%' GROUP BY doc_id"""
    out["customer_frequency"] = sql(tx, """SELECT mios_trans_code, bankacc_id_type, bankacc_id_no, trans_stat, kk_cnt,
 customer_cnt FROM tx LEFT JOIN (SELECT bankacc_id_type AS t, bankacc_id_no AS n, trans_stat AS s, count(*) AS kk_cnt
 FROM tx GROUP BY ALL) a ON t = bankacc_id_type AND n = bankacc_id_no AND s = trans_stat
 LEFT JOIN (SELECT bankacc_id_type AS t2, bankacc_id_no AS n2, count(*) AS customer_cnt FROM tx GROUP BY ALL) b
 ON t2 = bankacc_id_type AND n2 = bankacc_id_no""")
    keys = "trans_stat, bankacc_id_type, bankacc_id_no"
    out["dedup_month"] = sql(tx, f"""SELECT mios_trans_code, {keys} FROM tx WHERE mios_trans_code IN
 (SELECT min(mios_trans_code) FROM tx GROUP BY {keys})""")
    out["dedup_year"] = sql([TX, ATTR], f"""SELECT mios_trans_code, {keys}, acc_cust_month FROM attr RIGHT JOIN
 (SELECT min(mios_trans_code) AS code, acc_cust_month AS m FROM attr GROUP BY {keys}, acc_cust_month)
 ON mios_trans_code = code AND acc_cust_month = m""")
    out["active_features"] = sql(BASE, " UNION ALL ".join(
        f"SELECT '{f.col_name}' AS col_name, count({f.col_name}) AS n_values, '{mode}' AS mode FROM cust"
        for mode, fs in (("all", ACTIVE), ("month", MONTH), ("year", YEAR)) for f in fs
    ))
    amount = fx.FEATURES[3]._replace(col_name="trans_amnt", pcode="41000")
    out["feature_values"] = sql(BASE, "SELECT DISTINCT pcode AS feature_pcode, value AS feature_value FROM "
                                f"({feature_rows('cust', [*ACTIVE, amount])})")
    out["feature_catalog"] = sql(CATALOG, "SELECT * FROM cat")
    old = feature_rows("(SELECT * FROM cust WHERE year_id = 1996 AND month_id = 3)", ACTIVE)
    out["catalog_extend"] = sql(
        [*BASE, FEATS, VALS, f"oldvals AS (SELECT DISTINCT pcode, value FROM ({old}))", catalog("old", "oldvals"),
         "newvals AS (SELECT pcode, value FROM vals EXCEPT SELECT pcode, value FROM oldvals)",
         catalog("new", "newvals")],
        """SELECT * FROM old UNION ALL SELECT
 CAST(CAST(feature_id AS INT) + (SELECT count(*) FROM old) AS VARCHAR),
 CAST(CAST(feature_code AS INT) + (SELECT count(*) FROM old o WHERE o.feature_pcode = n.feature_pcode) AS VARCHAR),
 feature_value, feature_name, feature_pcode, feature_ptype, feature_desc, feature_weight FROM new n""")
    out["portrait"] = sql([*CATALOG, portrait("pho", "cust", MONTH)], "SELECT id AS mios_trans_code, features FROM pho")
    out["slot_explode"] = sql([*BASE, TERMS, "l AS (SELECT id, list_sort(list(code)) AS c FROM terms GROUP BY id)"],
                              "SELECT id AS mios_trans_code, " + ", ".join(f"c[{i}] AS feature{i}" for i in range(1, 6))
                              + " FROM l")
    index = [
        "cnts AS (SELECT slot, code, count(*) AS cnt FROM chosen GROUP BY slot, code)",
        "idx AS MATERIALIZED (SELECT slot, code, cnt, CAST(row_number() OVER (PARTITION BY slot ORDER BY cnt DESC, code) - 1 AS INT) "
        "AS idx, CAST(count(*) OVER (PARTITION BY slot) AS INT) AS width, "
        "CAST(row_number() OVER (ORDER BY slot, cnt DESC, code) - 1 AS INT) AS pos FROM cnts)",
    ]
    whole = [*BASE, TERMS, "chosen AS (SELECT * FROM terms)", *index]
    out["slot_index"] = sql(whole, "SELECT * FROM idx")
    out["dictionary"] = sql(whole, """SELECT slot AS feature_code, code AS feature_col_name, '1' AS feature_value,
 CAST(width AS VARCHAR) AS feature_vector_cnt, CAST(idx AS VARCHAR) AS feature_vector_index FROM idx""")
    batch = "chosen AS (SELECT t.* FROM terms t JOIN cust c ON c.mios_trans_code = t.id WHERE c.trans_bat_no = 'B199603')"
    out["encode_new"] = sql([*BASE, TERMS, batch, *index], """SELECT t.id AS mios_trans_code,
 coalesce(string_agg(CAST(i.pos AS VARCHAR), ',' ORDER BY i.pos), '') AS active FROM terms t
 LEFT JOIN idx i ON i.slot = t.slot AND i.code = t.code GROUP BY t.id""")
    out["label_modes"] = sql(tx, f"""SELECT mios_trans_code, {LABEL} AS "binary",
 coalesce({AMOUNT}, 0.0::DOUBLE) AS "numeric", 0.0::DOUBLE AS not_numeric FROM tx""")

    def weights(kind: str, label: str) -> str:
        inner = sql([*BASE, rows(label), TERMS, *levels()],
                    "SELECT cc.label, CAST(cc.k AS BIGINT) AS cnt, cw.v FROM cc JOIN cw ON cw.label = cc.label")
        return f"SELECT '{kind}' AS kind, label, cnt, round(v, 6) AS weight FROM ({inner})"

    out["class_weights"] = weights("trans_stat", LABEL) + " UNION ALL " + weights("order_status", LABEL3)
    priced = """priced AS MATERIALIZED (SELECT CAST(l_extendedprice AS DOUBLE) AS label,
 CASE WHEN l_linenumber % 3 = 0 THEN floor(CAST(l_extendedprice AS DOUBLE)) ELSE CAST(l_extendedprice AS DOUBLE)
 END AS prediction FROM lineitem)"""
    out["class_weights_many"] = sql([priced], """SELECT label, cnt, round(o / sum(o) OVER () * 1000000, 6) AS weight_ppm
 FROM (SELECT label, cnt, (1 - cnt / n) / (cnt / n) AS o FROM (SELECT label, count(*) AS cnt,
 CAST(sum(count(*)) OVER () AS DOUBLE) AS n FROM priced GROUP BY label))""")
    out["metrics_many"] = sql(
        [priced, """classes AS MATERIALIZED (SELECT c, CAST(sum(s) AS DOUBLE) AS sup, CAST(sum(p) AS DOUBLE) AS prd,
 CAST(sum(h) AS DOUBLE) AS tp, (SELECT CAST(count(*) AS DOUBLE) FROM priced) AS n FROM
 (SELECT label AS c, 1 AS s, 0 AS p, CASE WHEN label = prediction THEN 1 ELSE 0 END AS h FROM priced
  UNION ALL SELECT prediction, 0, 1, 0 FROM priced) GROUP BY c)""",
         """each AS (SELECT *, CASE WHEN prd = 0 THEN 0 ELSE tp / prd END AS prec, CASE WHEN sup = 0 THEN 0 ELSE tp / sup END AS rec
 FROM classes)"""],
        """SELECT CAST(sum(sup) AS BIGINT) AS n_rows, CAST(sum(tp) AS BIGINT) AS n_correct,
 round(sum(tp) / sum(sup), 6) AS accuracy, round(sum(sup / n * prec), 6) AS precision, round(sum(sup / n * rec), 6) AS recall,
 round(sum(sup / n * CASE WHEN prec + rec = 0 THEN 0 ELSE 2 * prec * rec / (prec + rec) END), 6) AS f1,
 round(sum(sup / n * (prd - tp) / (n - sup)) * 1000000, 6) AS fpr_ppm FROM each""")
    out["check_features"] = " UNION ALL ".join(
        f"""SELECT '{n}' AS feature, count(*) AS n_rows, count(*) FILTER ({e} < 0) AS n_negative,
 count(*) FILTER ({e} NOT IN (0, 1) OR {e} IS NULL) AS n_not_binary, count(*) FILTER ({e} < 0) = 0 AS multinomial_ok,
 count(*) FILTER ({e} NOT IN (0, 1) OR {e} IS NULL) = 0 AS bernoulli_ok FROM lineitem"""
        for n, e in (("l_quantity", "l_quantity"), ("l_discount", "l_discount"),
                     ("returned", "CAST(l_returnflag = 'R' AS INT)"), ("gap", "(l_quantity - 25)"))
    )
    weighted = rows(weight="coalesce(amount / 130000, 1)")
    out["nb_stats"] = sql([*BASE, TERMS, weighted], """SELECT label, '' AS slot, '' AS code, round(sum(w), 6) AS sum_w
 FROM rows GROUP BY label UNION ALL SELECT r.label, t.slot, t.code, round(sum(r.w), 6) FROM rows r
 JOIN terms t ON t.id = r.id GROUP BY r.label, t.slot, t.code""")

    def model(kind: str, label: str) -> str:
        ctes = [*BASE, TERMS, rows(label), *fit()]
        return f"SELECT * FROM ({sql(ctes, flat_model(1, q(kind) + ' AS kind'))})"

    out["nb_model"] = model("trans_stat", LABEL) + " UNION ALL " + model("order_status", LABEL3)
    plain = "label, slot, code, value"
    out["nb_plain"] = sql([*BASE, TERMS, weighted, *fit(lam=0.5, extra="0")],
                          f"SELECT {plain} FROM ({flat_model(1, '1')})")
    own = "ln(CASE WHEN cw.label = 0 THEN 0.7::DOUBLE ELSE 0.3::DOUBLE END)"
    out["nb_custom_weights"] = sql([*BASE, TERMS, rows(), *fit(extra=own)], f"SELECT {plain} FROM ({flat_model(1, '1')})")
    out["nb_bernoulli"] = sql(
        [*BASE, TERMS, rows(), *fit("bernoulli"),
         "absent AS (SELECT label, sum(ln(1 - exp(v))) AS v FROM theta0 GROUP BY label)",
         "braw AS MATERIALIZED (SELECT r.id, p.label, min(p.v) + min(a.v) + sum(h.v - ln(1 - exp(h.v))) AS v "
         "FROM rows r JOIN prior0 p ON TRUE JOIN absent a ON a.label = p.label JOIN terms t ON t.id = r.id "
         "JOIN theta0 h ON h.label = p.label AND h.slot = t.slot AND h.code = t.code GROUP BY r.id, p.label)",
         softmax("bprob", "braw", "v", "id")],
        pick("braw", "bprob"))
    out["nb_score"] = sql(NB, pick("score0", "prob0"))
    out["nb_thresholds"] = sql(NB, pick("score0", "prob0", (0.35, 0.65)))

    out["nb_values"] = """WITH x AS (SELECT *, CAST(l_returnflag = 'R' AS DOUBLE) AS label, l_extendedprice / 10000 AS price
 FROM lineitem), c AS (SELECT label, CAST(count(*) AS DOUBLE) AS k, sum(l_quantity) AS a, sum(l_tax) AS b,
 sum(price) AS d FROM x GROUP BY label),
m AS (SELECT label, ln(k + 1) - ln(sum(k) OVER () + 2) + ln(1 - k / sum(k) OVER ()) AS p,
 ln((a + 1) / (a + b + d + 3)) AS ta, ln((b + 1) / (a + b + d + 3)) AS tb, ln((d + 1) / (a + b + d + 3)) AS td FROM c),
s AS (SELECT x.label, m0.p + l_quantity * m0.ta + l_tax * m0.tb + price * m0.td AS r0,
 m1.p + l_quantity * m1.ta + l_tax * m1.tb + price * m1.td AS r1 FROM x, m m0, m m1 WHERE m0.label = 0 AND m1.label = 1)
SELECT label, CASE WHEN r1 > r0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, count(*) AS n_rows,
 round(avg(r0), 6) AS raw0, round(avg(1 / (1 + exp(r0 - r1))), 6) AS p1 FROM s GROUP BY 1, 2"""

    def rounds_of(n: int, alpha: str = "half_log", model: str = "''") -> str:
        return sql([*BASE, TERMS, rows(model=model), *boost(n, alpha)], " UNION ALL ".join(
            f"SELECT model AS model_id, {r} AS round, round(e, 6) AS error, round(alpha, 6) AS alpha FROM step{r}"
            for r in range(n)))

    out["boost_rounds"] = rounds_of(4)
    out["boost_samme"] = rounds_of(3, "samme")
    out["boost_by_month"] = rounds_of(2, model="month_id")
    out["boost_score"] = sql([*BASE, TERMS, rows(), *boosted(3)],
                             pick("raw", "prob", more=", round(max(p), 6) AS confidence"))
    table = [
        (n, now, i + 1, w) for n, now in ((12, 1), (12, 8), (12, 12), (5, 8)) for i, w in enumerate(month_weights_sql(n, now))
    ]
    out["month_weights"] = sql([TX, f"mw(n, current_month, month_id, weight) AS ({values(table)})"],
                               """SELECT mw.n, mw.current_month, mw.month_id, round(CAST(mw.weight AS DOUBLE), 6) AS weight,
 round(CAST(mw.weight AS DOUBLE) * count(*), 6) AS weighted FROM tx JOIN mw ON mw.month_id = tx.month_id
 GROUP BY mw.n, mw.current_month, mw.month_id, mw.weight""")
    out["year_vote"] = year(2, "joint", None)
    out["year_prob"] = year(2, "joint", "blend")
    out["year_vote_of_votes"] = year(2, "boost", "blend")
    out["year_equal"] = year(1, "joint", "mean")
    out["key_split"] = sql(tx, f"SELECT mios_trans_code, {PART} AS part FROM tx")
    out["confusion"] = sql(NB, f"SELECT label, pred AS prediction, count(*) AS cnt FROM ({PREDICTED}) GROUP BY ALL")
    out["metrics"] = sql([*NB, f"done AS MATERIALIZED ({PREDICTED})"],
                         metric_row("label", "pred", "FALSE") + " UNION ALL " + metric_row("pred", "label", "TRUE"))
    out["softmax_shares"] = """SELECT c_custkey, """ + ", ".join(
        f"round(exp(s{i} - m) / (exp(s0 - m) + exp(s1 - m) + exp(s2 - m)), 6) AS share{i}" for i in range(3)
    ) + """, round(100 / (exp(s0 - m) + exp(s1 - m) + exp(s2 - m)), 2) AS best_percent
 FROM (SELECT *, greatest(s0, s1, s2) AS m FROM (SELECT c_custkey, c_acctbal / 1000 AS s0,
 c_nationkey / 3.0::DOUBLE AS s1, 2.5::DOUBLE AS s2 FROM customer))"""
    out["attach_predictions"] = sql(NB, f"""SELECT mios_trans_code, trans_code, trans_bat_no,
 CASE WHEN {PART} = 'test' THEN p.pred END AS train_label, CASE WHEN {PART} = 'test' THEN round(b.p, 6) END AS train_accuracy
 FROM cust JOIN pred0 p ON p.id = mios_trans_code JOIN prob0 b ON b.id = p.id AND b.label = p.pred""")
    out["decode_features"] = sql([*CATALOG, portrait("pho", "cust", ACTIVE)], """SELECT p.id AS mios_trans_code,
 p.features || '_99999' AS features, string_agg(' ;' || c.feature_ptype || ': ' || c.feature_desc, '' ORDER BY p.code)
 || ' ;' AS features_desc FROM (SELECT id, features, unnest(string_split(features, '_')) AS code FROM pho) p
 JOIN cat c ON c.feature_code = p.code GROUP BY p.id, p.features""")
    out["cluster_assign"] = sql(BASE, f"SELECT mios_trans_code, {NEAREST} AS acc_cust_km FROM (SELECT *, {DIST} FROM cust)")
    out["cluster_report"] = sql(BASE, f"""SELECT {NEAREST} AS cluster, count(*) AS n_rows,
 round(sum(list_min(dist)), 6) AS cost FROM (SELECT *, {DIST} FROM cust) GROUP BY 1""")
    out["cluster_train"] = sql(
        [*BASE, *bisected("cust")],
        "SELECT l.cluster, n_rows, n_assigned, round(cost, 6) AS cost, "
        + ", ".join(f"round({x}, 6) AS center_{c}" for c, x in zip(POINT, XS))
        + " FROM leaves l JOIN (SELECT cluster, count(*) AS n_assigned FROM places GROUP BY cluster) a ON a.cluster = l.cluster")
    out["job_features_trained"] = sql(
        [*BASE, FREQ, *bisected("cust", "year_id = 1996")],
        """SELECT c.mios_trans_code, p.cluster AS acc_cust_km, f.kk_cnt, round(l.cost, 6) AS km_cost FROM cust c
 JOIN places p ON p.id = c.mios_trans_code JOIN leaves l ON l.cluster = p.cluster
 LEFT JOIN freq f ON f.t = c.bankacc_id_type AND f.n = c.bankacc_id_no AND f.s = c.trans_stat""")
    out["display"] = sql(BASE, f"SELECT {display_columns()} FROM cust")
    out["sinks_roundtrip"] = sql([*BASE, TERMS, rows(), *boosted(2), WINNER], """SELECT target, trans_stat, count(*) AS n_rows
 FROM (SELECT 'parts' AS target, CASE WHEN year_id = 1997 THEN '9' ELSE trans_stat END AS trans_stat FROM tx
 UNION ALL SELECT unnest(['whole', 'csv', 'json']), trans_stat FROM tx
 UNION ALL SELECT 'model', CAST(CAST(label AS INT) AS VARCHAR) FROM win) GROUP BY target, trans_stat""")
    out["job_features"] = sql([*BASE, FREQ, FULL], """SELECT mios_trans_code, acc_cust_sex, acc_cust_home, acc_cust_age,
 acc_cust_agerang, acc_cust_instancetype, acc_cust_amntrang, acount_time_rang, acc_cust_month, acc_cust_day,
 acc_cust_dayrang, acc_cust_km, kk_cnt FROM full_cust""")
    out["job_catalog"] = out["feature_catalog"]
    out["job_train_month"] = sql(
        [*month_training(3), *round_scores_of(3, "rows"), WINNER],
        """SELECT r.id AS mios_trans_code, p.features, CASE WHEN NOT r.train THEN w.label END AS train_label,
 CASE WHEN NOT r.train THEN round(w.p, 6) END AS train_accuracy FROM rows r JOIN pho p ON p.id = r.id
 JOIN win w ON w.id = r.id""")
    everyone = "everyone AS MATERIALIZED (SELECT mios_trans_code AS id, '' AS model FROM cust)"
    out["job_score_month"] = sql(
        [*month_training(2), everyone, *round_scores_of(2, "everyone"), WINNER],
        """SELECT p.id AS mios_trans_code, p.features, w.label AS train_label, round(w.p, 6) AS train_accuracy
 FROM pho p JOIN win w ON w.id = p.id""")
    out["job_train_year"] = year_job(test_only=True)
    out["job_score_year"] = year_job(test_only=False)
    shown = {
        "sys_no": "'S1' AS sys_no", "acc_cust_name": "'N' || bankacc_id_no AS acc_cust_name", "features": "p.features",
        "train_label": "CASE WHEN NOT r.train THEN w.label END AS train_label",
        "train_accuracy": "CASE WHEN NOT r.train THEN round(w.p, 6) END AS train_accuracy",
    }
    columns = ", ".join(shown.get(c, f"f.{c}") for c in DISPLAY_COLUMNS)
    text = """texts AS (SELECT p.id, string_agg(' ;' || c.feature_ptype || ': ' || c.feature_desc, '' ORDER BY p.code)
 AS features_desc FROM (SELECT id, unnest(string_split(features, '_')) AS code FROM pho) p
 JOIN cat c ON c.feature_code = p.code GROUP BY p.id)"""
    out["job_display"] = sql(
        [*month_training(2), *round_scores_of(2, "rows"), WINNER, text],
        f"""SELECT {columns}, x.features_desc, 2001 AS year_id, {fx.CURRENT_MONTH} AS month_id FROM rows r
 JOIN full_cust f ON f.mios_trans_code = r.id JOIN pho p ON p.id = r.id JOIN win w ON w.id = r.id
 JOIN texts x ON x.id = r.id""")
    assert "2001 AS year_id, 8 AS month_id" in out["job_display"]
    out["job_display_published"] = out["job_display"].replace(
        "2001 AS year_id, 8 AS month_id", "2001 AS year_id, m.month_id") + (
        " JOIN (VALUES (7), (8)) AS m(month_id) ON m.month_id = 8 OR f.trans_stat = '1'")
    kept_terms = "SELECT t.slot, t.code FROM terms t JOIN {rows} r ON r.id = t.id"
    out["job_month_tables"] = sql(
        [*month_training(2), *round_scores_of(2, "rows"), WINNER, *positions(kept_terms.format(rows="rows")),
         "done AS MATERIALIZED (SELECT r.label, w.label AS pred FROM rows r JOIN win w ON w.id = r.id WHERE NOT r.train)"],
        saved_tables(metric_row("label", "pred", "FALSE")))
    out["job_year_tables"] = sql(
        [*year_training(), *positions(kept_terms.format(rows="yrows")),
         "done AS MATERIALIZED (SELECT r.label, y.label AS pred FROM yrows r JOIN ywin y ON y.id = r.id WHERE r.part = 'test')"],
        saved_tables(metric_row("label", "pred", "FALSE"))
        + """ UNION ALL SELECT 'predictions', r.id, p.features, CAST(CAST(y.label AS INT) AS VARCHAR),
 round(round(b.p * 100, 2), 6) FROM yrows r JOIN ypho p ON p.id = r.id JOIN ywin y ON y.id = r.id
 JOIN blend b ON b.id = r.id AND b.label = y.label""")
    # The queries' training batches, stated once more.
    out["score_unseen"] = unseen_month("year_id = 1996 AND month_id = 3")
    out["score_unseen_year"] = unseen_year("year_id <= 1995")
    out["job_load"] = sql(tx, f"""SELECT {STAGED}, p.part FROM tx JOIN (VALUES ('month'), ('year')) AS p(part)
 ON p.part = 'year' OR month_id = 5 WHERE year_id = 1997""")
    return out


ORACLE: dict[str, str] = _statements()
