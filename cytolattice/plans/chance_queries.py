"""Queries on co-labelling against chance."""

from pyspark.sql import functions as F

from ..operators import chance as C
from ..operators import hierarchy as H
from ..operators import markers as M
from ..operators import neighbours as N
from ..session import settle_alone
from .bindings import PANEL, view
from .cell_queries import cells, classed, stored_cells
from .region_queries import closure
from .registry import CTES, query, tidy

CHANCE_KS = (0.3, 0.5, 0.6, 0.8, 0.9, 1.0, 1.1, 1.2)      # the tables hold nothing above 1.4
P = 2147483647


FLAGGED = ("cell_id", "section", "acronym", "x", "y", "nucleus_area_um2", "anchor_mean", "tdt_bgsub", "tagged", "activity")


def flagged(spark, d):
    """Cells with their flags and the columns that these queries read."""
    return settle_alone(spark, lambda: M.role_flags(classed(spark, d), PANEL).select(*FLAGGED), "flagged")


def parents(spark, d):
    """Region list: the tree's first level, rolled down to its members."""
    first = view(spark, d, "fx_edges").where("parent = 'root'").select(F.col("acronym").alias("ancestor"))
    return closure(spark, d).join(first, "ancestor").select(F.col("ancestor").alias("region"), F.col("descendant").alias("acronym"))


def served(spark, d):
    return C.region_members(flagged(spark, d), parents(spark, d))


CTES["served"] = """SELECT f.*, c.ancestor AS region FROM flagged f JOIN closure c ON c.descendant = f.acronym
    WHERE c.ancestor IN (SELECT acronym FROM fx_edges WHERE parent = 'root')"""
_CNT = """count(*) AS n, count(*) FILTER (tagged) AS tagged_n, count(*) FILTER (activity) AS activity_n, count(*) FILTER (tagged AND activity) AS double_n"""
_AC = "round(CASE WHEN tagged_n > 0 AND activity_n > 0 THEN double_n::DOUBLE * n / (tagged_n::DOUBLE * activity_n) END, 6)"


def mixed(expr):
    """SQL of the library's scramble."""
    y = f"((({expr}) * 48271 + 11) % {P})"
    sq = f"(({y} * {y}) % {P})"
    return f"((({sq} * {sq}) % {P}) * {y}) % {P}"


def drawn(seed=0):
    """SQL of the library's permutation of ids: ordered by hh4, ll4."""
    items = ["cell_id // 4294967296 AS hh0", "cell_id % 4294967296 AS ll0"]
    for t in range(C.TURNS):
        items += [f"(ll{t} % {P} * 48271 + {1000003 * (C.TURNS * seed + t + 1)}) % {P} AS yy{t}", f"xor(hh{t}, (yy{t} * yy{t}) % {P}) AS ll{t + 1}", f"ll{t} AS hh{t + 1}"]
    return ", ".join(items)


@query("above_chance", f"SELECT section, n, tagged_n, activity_n, double_n, {_AC} AS above_chance FROM (SELECT section, {_CNT} FROM flagged GROUP BY section)")
def above_chance(spark, d):
    return tidy(C.above_chance_by(flagged(spark, d), ["section"]))


@query("naive_ratio", f"SELECT acronym, {_AC} AS naive FROM (SELECT acronym, {_CNT} FROM flagged GROUP BY acronym)")
def naive_ratio(spark, d):
    return tidy(C.naive_ratio(flagged(spark, d), ["acronym"]))


CTES["floors"] = """SELECT region, any_value(base) AS base, any_value(n) AS n, max(v) FILTER (rn = floor(h)) + (max(v) FILTER (rn = ceil(h)) - max(v) FILTER (rn = floor(h))) * (any_value(h) - floor(any_value(h))) AS cut
    FROM (SELECT s.region, anchor_mean AS v, base, n, (n - 1) * p AS h, row_number() OVER (PARTITION BY s.region ORDER BY anchor_mean) - 1 AS rn FROM served s
      JOIN (SELECT region, 1 - avg(tagged::INT) AS p, count(*) AS n, avg(activity::INT) AS base FROM served GROUP BY region) q ON q.region = s.region) GROUP BY region"""


@query("quantile_cut", "SELECT region, round(cut, 6) AS cut FROM floors")
def quantile_cut(spark, d):
    return tidy(C.anchor_floor(served(spark, d), ["region"]).select("region", "cut"))


_FLOOR = "SELECT s.region, avg(activity::INT) FILTER (anchor_mean > cut) / any_value(base) AS anchor_floor FROM served s JOIN floors f ON f.region = s.region GROUP BY s.region HAVING count(*) >= 200"


@query("anchor_floor", f"SELECT region, round(anchor_floor, 6) AS anchor_floor FROM ({_FLOOR})")
def anchor_floor(spark, d):
    return tidy(C.anchor_floor(served(spark, d), ["region"]).select("region", "anchor_floor"))


@query("shuffled_control", f"""WITH u AS (SELECT *, {drawn()} FROM flagged), o AS (SELECT *, row_number() OVER (PARTITION BY section ORDER BY hh4, ll4) AS rn, count(*) FILTER (tagged) OVER (PARTITION BY section) AS t FROM u),
    c AS (SELECT section, count(*) AS n, count(*) FILTER (tagged) AS tagged_n, count(*) FILTER (activity) AS activity_n, count(*) FILTER (activity AND rn <= t) AS double_n FROM o GROUP BY section)
    SELECT section, n, tagged_n, activity_n, {_AC} AS shuffled FROM c""")
def shuffled_control(spark, d):
    return tidy(C.shuffled_control(flagged(spark, d), ["section"]))


_KVC = f"""WITH s AS (SELECT median(tdt_bgsub) AS tm, median(fos_bgsub) AS fm FROM fx_cells),
    s2 AS (SELECT any_value(tm) AS tm, any_value(fm) AS fm, CAST(1.4826 AS DOUBLE) * median(abs(tdt_bgsub - tm)) AS ts, CAST(1.4826 AS DOUBLE) * median(abs(fos_bgsub - fm)) AS fs FROM fx_cells CROSS JOIN s),
    ks AS (SELECT unnest([0.3, 0.5, 0.6, 0.8, 0.9, 1.0, 1.1, 1.2])::DOUBLE AS k),
    f AS (SELECT k, cell_id, anchor_mean, tdt_bgsub > tm + k * ts AS tagged, fos_bgsub > fm + k * fs AS activity,
      row_number() OVER (PARTITION BY k ORDER BY hh4, ll4) AS rn, row_number() OVER (PARTITION BY k ORDER BY anchor_mean) - 1 AS an FROM (SELECT *, {drawn()} FROM fx_cells) CROSS JOIN s2 CROSS JOIN ks),
    t AS (SELECT k, count(*) AS n, count(*) FILTER (tagged) AS tagged_n, (count(*) - 1) * (1 - count(*) FILTER (tagged) / count(*)) AS h FROM f GROUP BY k),
    c AS (SELECT f.k, any_value(n) AS n, any_value(tagged_n) AS tagged_n, max(anchor_mean) FILTER (an = floor(h)) + (max(anchor_mean) FILTER (an = ceil(h)) - max(anchor_mean) FILTER (an = floor(h))) * (any_value(h) - floor(any_value(h))) AS cut
      FROM f JOIN t ON t.k = f.k GROUP BY f.k),
    a AS (SELECT f.k, any_value(c.n) AS n, any_value(c.tagged_n) AS tagged_n, count(*) FILTER (activity) AS activity_n, count(*) FILTER (tagged AND activity) AS double_n,
      count(*) FILTER (activity AND rn <= c.tagged_n) AS sn, count(*) FILTER (anchor_mean > cut) AS pn, count(*) FILTER (anchor_mean > cut AND activity) AS qn FROM f JOIN c ON c.k = f.k GROUP BY f.k),
    r AS (SELECT *, CASE WHEN tagged_n > 0 AND activity_n > 0 THEN double_n::DOUBLE * n / (tagged_n::DOUBLE * activity_n) END AS ac,
      CASE WHEN tagged_n > 0 AND activity_n > 0 THEN sn::DOUBLE * n / (tagged_n::DOUBLE * activity_n) END AS sh, CASE WHEN pn > 0 AND activity_n > 0 THEN qn::DOUBLE * n / (pn::DOUBLE * activity_n) END AS fl FROM a)"""


@query("k_vs_chance", f"""{_KVC} SELECT k, n, tagged_n, activity_n, double_n, round(100.0 * tagged_n / n, 6) AS tagged_pct, round(100.0 * activity_n / n, 6) AS activity_pct,
    round(CASE WHEN tagged_n > 0 THEN 100.0 * double_n / tagged_n END, 6) AS reactivation_pct, round(ac, 6) AS above_chance, round(sh, 6) AS shuffled, round(fl, 6) AS anchor_floor,
    round(CASE WHEN fl > 0 THEN ac / fl END, 6) AS real_over_floor FROM r""")
def k_vs_chance(spark, d):
    return tidy(C.k_vs_chance(stored_cells(spark, d), PANEL, CHANCE_KS))


@query("k_vs_chance_verdict", f"""{_KVC}, v AS (SELECT count(*) AS points, arg_min(ac, k) AS lo, arg_max(ac, k) AS hi, max(abs(sh - 1)) AS off, arg_min(fl, k) AS f0, arg_max(fl, k) AS f1 FROM r WHERE ac IS NOT NULL)
    SELECT points, round(lo, 6) AS lo, round(hi, 6) AS hi, CASE WHEN points < 2 THEN 'too few points' WHEN off > 0.15 THEN 'STOP' WHEN hi < lo * 0.8 THEN 'FALLS' WHEN hi > lo * 1.2 THEN 'RISES' ELSE 'FLAT' END AS verdict,
      coalesce(f1 > f0 * 1.2, FALSE) AS floor_rises FROM v""")
def k_vs_chance_verdict(spark, d):
    return tidy(C.k_vs_chance_verdict(C.k_vs_chance(stored_cells(spark, d), PANEL, CHANCE_KS)))


CTES["local_sec"] = """SELECT region, section, count(*) AS tagged_n, avg(act::INT) AS observed, avg(rate) AS local_rate FROM (
    SELECT region, section, cell_id, any_value(act) AS act, avg(pact::INT) AS rate, count(*) AS c FROM (
      SELECT t.region, t.section, t.cell_id, t.activity AS act, p.activity AS pact, row_number() OVER (PARTITION BY t.region, t.cell_id ORDER BY (t.x - p.x) ** 2 + (t.y - p.y) ** 2, p.cell_id) AS rn
      FROM served t JOIN served p ON p.region = t.region AND p.section = t.section AND t.tagged AND NOT p.tagged) WHERE rn <= 20 GROUP BY region, section, cell_id) WHERE c = 20 GROUP BY region, section"""
_LOC = """SELECT region, count(*) AS n_sections, CAST(sum(tagged_n) AS BIGINT) AS tagged_n, sum(observed * tagged_n) / sum(tagged_n) AS observed,
    sum(local_rate * tagged_n) / sum(tagged_n) AS local_chance, sum(observed * tagged_n) / sum(local_rate * tagged_n) AS above_chance_local FROM local_sec GROUP BY region"""


def local_sections(spark, d):
    return C.local_sections(served(spark, d), 20)


_BOOT = f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY section) - 1 AS i, count(*) OVER (PARTITION BY region) AS s FROM local_sec),
    p AS (SELECT region, b, ({mixed('((b + 1) * 1000003 + i * 7919) % ' + str(P))}) % s AS i FROM r CROSS JOIN (SELECT unnest(range(0, 1000)) AS b) WHERE s >= 3),
    q AS (SELECT p.region, b, sum(observed * tagged_n) / sum(local_rate * tagged_n) AS v FROM p JOIN r ON r.region = p.region AND r.i = p.i GROUP BY p.region, b)
    SELECT region, round(quantile_cont(v, 0.025), 6) AS ci_lo, round(quantile_cont(v, 0.975), 6) AS ci_hi, 'section-level' AS ci_scheme FROM q WHERE v IS NOT NULL GROUP BY region"""


# Percent points of a binomial share, from its distribution.
_BINOM = """SELECT region, min(k) FILTER (cdf >= 0.025) / any_value(n) AS lo, min(k) FILTER (cdf >= 0.975) / any_value(n) AS hi FROM (
    SELECT region, n, k, sum(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(p) + (n - k) * ln(1 - p))) OVER (PARTITION BY region ORDER BY k) AS cdf
    FROM (SELECT region, n, p, unnest(range(0, n + 1)) AS k FROM ({source}) WHERE n > 0 AND p > 0 AND p < 1)) GROUP BY region"""
CTES["local_rows"] = f"""SELECT r.region, coalesce(n_sections, 0) AS n_sections, coalesce(l.tagged_n, 0) AS tagged_n, observed, local_chance, above_chance_local,
    CASE WHEN n_sections >= 3 THEN b.ci_lo ELSE q.lo / local_chance END AS ci_lo, CASE WHEN n_sections >= 3 THEN b.ci_hi ELSE q.hi / local_chance END AS ci_hi,
    CASE WHEN n_sections >= 3 THEN 'section-level' WHEN coalesce(l.tagged_n, 0) > 0 THEN 'cell-level (' || n_sections || ' section(s) -- WITHIN-section precision only)' ELSE 'n/a' END AS ci_scheme
    FROM (SELECT DISTINCT region FROM served) r LEFT JOIN ({_LOC}) l ON l.region = r.region LEFT JOIN ({_BOOT}) b ON b.region = r.region
    LEFT JOIN ({_BINOM.format(source=f"SELECT region, tagged_n AS n, observed AS p FROM ({_LOC})")}) q ON q.region = r.region"""
_LOC_OUT = """region, n_sections, tagged_n, round(observed, 6) AS observed, round(local_chance, 6) AS local_chance, round(above_chance_local, 6) AS above_chance_local,
    round(ci_lo, 6) AS ci_lo, round(ci_hi, 6) AS ci_hi, ci_scheme"""


@query("local_chance", f"SELECT {_LOC_OUT} FROM local_rows")
def local_chance(spark, d):
    return tidy(C.local_table(served(spark, d), 20))


@query("local_chance_order", f"SELECT {_LOC_OUT} FROM local_rows l ORDER BY l.above_chance_local DESC NULLS LAST, region")
def local_chance_order(spark, d):
    return tidy(C.local_chance_order(C.local_table(served(spark, d), 20)))


@query("bootstrap_sections", _BOOT)
def bootstrap_sections(spark, d):
    return tidy(C.bootstrap_sections(local_sections(spark, d), 1000))


@query("bootstrap_cells", f"""WITH l AS ({_LOC}), k AS (SELECT region, tagged_n, observed, local_chance, unnest(range(0, tagged_n + 1)) AS k FROM l),
    m AS (SELECT *, sum(exp(lgamma(tagged_n + 1) - lgamma(k + 1) - lgamma(tagged_n - k + 1) + k * ln(observed) + (tagged_n - k) * ln(1 - observed))) OVER (PARTITION BY region ORDER BY k) AS cdf FROM k)
    SELECT region, any_value(tagged_n) AS tagged_n, round(any_value(observed), 6) AS observed, round(any_value(local_chance), 6) AS local_chance,
      round(min(k) FILTER (cdf >= 0.025) / any_value(tagged_n) / any_value(local_chance), 6) AS ci_lo, round(min(k) FILTER (cdf >= 0.975) / any_value(tagged_n) / any_value(local_chance), 6) AS ci_hi,
      'cell-level: within-section precision only' AS ci_scheme FROM m GROUP BY region""")
def bootstrap_cells(spark, d):
    return tidy(C.bootstrap_cells(C.local_chance(local_sections(spark, d))))


_OWN = "('0x' || substr(md5(s.region || chr(1) || s.section), 1, 7))::BIGINT"
_ROT = f"""WITH m AS (SELECT region, section, avg(x) AS cx, avg(y) AS cy, count(*) AS n, count(*) FILTER (tagged) AS t FROM served GROUP BY region, section),
    q AS (SELECT s.region, s.section, s.cell_id, r, n, x - cx AS dx, y - cy AS dy, cx, cy, 2 * pi() * ({mixed(f'((r + 1) * 1000003 + {_OWN}) % {P}')}) / {P}.0::DOUBLE AS th
      FROM served s JOIN m ON m.region = s.region AND m.section = s.section CROSS JOIN (SELECT unnest(range(0, 200)) AS r) WHERE tagged AND n >= 10),
    w AS (SELECT region, section, cell_id, r, n, cx + dx * cos(th) - dy * sin(th) AS x, cy + dx * sin(th) + dy * cos(th) AS y FROM q),
    d AS (SELECT w.region, w.r, w.cell_id, w.n, p.activity, row_number() OVER (PARTITION BY w.region, w.r, w.cell_id ORDER BY (w.x - p.x) ** 2 + (w.y - p.y) ** 2, p.cell_id) AS rn
      FROM w JOIN served p ON p.region = w.region AND p.section = w.section),
    a AS (SELECT region, r, cell_id, avg(activity::INT) AS act FROM d WHERE rn <= least(25, n - 1) GROUP BY region, r, cell_id),
    z AS (SELECT region, r, avg(act) AS v FROM a GROUP BY region, r), o AS (SELECT region, avg(activity::INT) AS obs FROM served WHERE tagged GROUP BY region)
    SELECT z.region, round(any_value(obs), 6) AS observed, round(avg(v), 6) AS null_mean, round(any_value(obs) / avg(v), 6) AS ratio, round((count(*) FILTER (v >= obs - 1e-12) + 1) / (count(*) + 1), 6) AS p
    FROM z JOIN o ON o.region = z.region GROUP BY z.region"""


@query("rotation_null", _ROT)
def rotation_null(spark, d):
    return tidy(C.rotation_null(served(spark, d), 200))


def covered(spark, d):
    c = flagged(spark, d)
    dens = settle_alone(spark, lambda: N.local_density(c, 20).select("cell_id", "local_density"), "density")
    return C.covariates(c.join(dens, "cell_id"), "tdt_bgsub")


def with_density(spark, d):
    return settle_alone(spark, lambda: covered(spark, d), "covariates")


def modelled(spark, d):
    """Cells with covariates by region, and all of them as one more region."""
    c = with_density(spark, d)
    return C.with_whole_project(C.region_members(c, parents(spark, d)), c)


CTES["covered"] = """SELECT f.*, ln(1 + greatest(tdt_bgsub, 0)) AS x1, ln(1 + coalesce(CASE WHEN md > 0 THEN 1 / md END, 0)) AS x2, ln(1 + greatest(nucleus_area_um2, 0)) AS x3
    FROM flagged f LEFT JOIN (SELECT cell_id, CASE WHEN count(*) = 20 THEN avg(sqrt(d2)) END AS md FROM (
      SELECT a.cell_id, (a.x - b.x) ** 2 + (a.y - b.y) ** 2 AS d2, row_number() OVER (PARTITION BY a.cell_id ORDER BY (a.x - b.x) ** 2 + (a.y - b.y) ** 2, b.cell_id) AS rn
      FROM flagged a JOIN flagged b ON a.section = b.section AND a.cell_id <> b.cell_id) WHERE rn <= 20 GROUP BY cell_id) n ON n.cell_id = f.cell_id"""
CTES["modelled"] = """SELECT c.*, p.ancestor AS region FROM covered c JOIN closure p ON p.descendant = c.acronym
    WHERE p.ancestor IN (SELECT acronym FROM fx_edges WHERE parent = 'root') UNION ALL SELECT c.*, '__ALL__' FROM covered c"""


def newton(source, steps=16):
    """SQL of a ridge logistic fit per region: unrolled Newton steps with Gaussian elimination; coefficients in the table ``fit``, scales in ``sc``."""
    at, ridge = range(4), 2e-4
    out = ["sc AS MATERIALIZED (SELECT region, " + ", ".join(f"avg(x{i}) AS m{i}, CASE WHEN stddev_pop(x{i}) > 0 THEN stddev_pop(x{i}) ELSE 1 END AS s{i}" for i in (1, 2, 3)) + f" FROM {source} GROUP BY region)",
           "z AS MATERIALIZED (SELECT n.region, activity::INT::DOUBLE AS y, 1.0::DOUBLE AS z0, " + ", ".join(f"(x{i} - m{i}) / s{i} AS z{i}" for i in (1, 2, 3)) + f" FROM {source} n JOIN sc ON sc.region = n.region)",
           "fit0 AS MATERIALIZED (SELECT region, " + ", ".join(f"0.0::DOUBLE AS b{i}" for i in at) + " FROM sc)"]
    for k in range(steps):
        sums = ", ".join([f"sum((q - y) * z{i}) AS g{i}" for i in at] + [f"sum(q * (1 - q) * z{i} * z{j}) AS h{i}{j}" for i in at for j in range(i, 4)])
        out.append(f"s{k} AS MATERIALIZED (SELECT region, {sums} FROM (SELECT z.*, 1 / (1 + exp(-({' + '.join(f'b{i} * z{i}' for i in at)}))) AS q FROM z JOIN fit{k} b ON b.region = z.region) GROUP BY region)")
        full = lambda i, j: f"h{min(i, j)}{max(i, j)}" + (f" + {ridge if i else 1e-12}" if i == j else "")
        items = [f"{full(i, j)} AS a0{i}{j}" for i in at for j in at] + [f"g{i}" + (f" + {ridge} * b{i}" if i else "") + f" AS r0{i}" for i in at]
        for p in range(3):
            for i in at:
                ratio = f"a{p}{i}{p} / a{p}{p}{p}" if i > p else "0"
                items += [f"a{p}{i}{j} - {ratio} * a{p}{p}{j} AS a{p + 1}{i}{j}" for j in at] + [f"r{p}{i} - {ratio} * r{p}{p} AS r{p + 1}{i}"]
        for i in reversed(at):
            items.append("(" + " - ".join([f"r3{i}"] + [f"a3{i}{j} * d{j}" for j in range(i + 1, 4)]) + f") / a3{i}{i} AS d{i}")
        out.append(f"fit{k + 1} AS MATERIALIZED (SELECT region, {', '.join(f'b{i} - d{i} AS b{i}' for i in at)} FROM (SELECT b.*, {', '.join(items)} FROM fit{k} b JOIN s{k} s ON s.region = b.region))")
    return ",\n".join(out) + f",\nfit AS (SELECT * FROM fit{steps})"


_PROBABLE = "1 / (1 + exp(-(b0 + " + " + ".join(f"b{i} * (x{i} - m{i}) / s{i}" for i in (1, 2, 3)) + ")))"


def _fitted(rows):
    """CTEs of the fitted read-out of ``rows``: table ``fitted``."""
    return f"""neg AS MATERIALIZED (SELECT m.* FROM {rows} m JOIN (SELECT region FROM {rows} GROUP BY region HAVING count(*) FILTER (NOT tagged) >= 200 AND count(*) FILTER (tagged) > 0) u
      ON u.region = m.region WHERE NOT tagged), {newton("neg")},
    told AS (SELECT m.region, avg(activity::INT) AS observed, avg({_PROBABLE}) AS expected FROM {rows} m JOIN sc ON sc.region = m.region JOIN fit ON fit.region = m.region WHERE tagged GROUP BY m.region),
    fitted AS (SELECT s.region, n_tagged, observed, expected, observed / expected AS ratio, CASE WHEN expected IS NOT NULL THEN TRUE END AS converged
      FROM (SELECT region, count(*) FILTER (tagged) AS n_tagged FROM {rows} GROUP BY region) s LEFT JOIN told ON told.region = s.region)"""


@query("fitted_expectation", f"""WITH {_fitted("modelled")} SELECT region, n_tagged, round(observed, 6) AS observed, round(expected, 6) AS expected, round(ratio, 6) AS ratio, converged FROM fitted""")
def fitted_expectation(spark, d):
    return tidy(C.fitted_expectation(modelled(spark, d)))


@query("validate_extrapolation", f"""WITH nn AS MATERIALIZED (SELECT * FROM modelled WHERE NOT tagged), q AS (SELECT region, quantile_cont(tdt_bgsub, 0.9) AS cut FROM nn GROUP BY region HAVING count(*) >= 1000),
    hi AS MATERIALIZED (SELECT nn.* FROM nn JOIN q ON q.region = nn.region WHERE tdt_bgsub > cut), ok AS (SELECT region FROM hi GROUP BY region HAVING count(*) >= 50),
    lo AS MATERIALIZED (SELECT nn.* FROM nn JOIN q ON q.region = nn.region JOIN ok ON ok.region = nn.region WHERE tdt_bgsub <= cut), {newton("lo")},
    v AS (SELECT hi.region, count(*) AS holdout_n, avg({_PROBABLE}) AS predicted, avg(activity::INT) AS actual FROM hi JOIN sc ON sc.region = hi.region JOIN fit ON fit.region = hi.region GROUP BY hi.region)
    SELECT r.region, holdout_n, round(predicted, 6) AS predicted, round(actual, 6) AS actual, round(predicted / nullif(actual, 0), 6) AS pred_over_actual,
      CASE WHEN predicted IS NOT NULL THEN TRUE END AS converged FROM (SELECT DISTINCT region FROM modelled) r LEFT JOIN v ON v.region = r.region""")
def validate_extrapolation(spark, d):
    return tidy(C.validate_extrapolation(modelled(spark, d), "tdt_bgsub"))


@query("expected_overlap", f"""WITH used AS MATERIALIZED (SELECT m.* FROM modelled m JOIN (SELECT region FROM modelled GROUP BY region HAVING count(*) >= 500) k ON k.region = m.region), {_fitted("used")},
    naive AS (SELECT region, count(*) AS n_cells, avg(activity::INT) FILTER (tagged) / nullif(avg(activity::INT), 0) AS naive FROM used GROUP BY region),
    q AS ({_BINOM.format(source="SELECT region, n_tagged AS n, observed AS p FROM fitted")})
    SELECT n.region, n_cells, n_tagged, round(observed, 6) AS observed, round(expected, 6) AS expected, round(ratio, 6) AS above_chance_fitted, round(naive, 6) AS above_chance_naive,
      round(q.lo / expected, 6) AS ci_lo, round(q.hi / expected, 6) AS ci_hi, converged FROM naive n JOIN fitted f ON f.region = n.region LEFT JOIN q ON q.region = n.region""")
def expected_overlap(spark, d):
    return tidy(C.expected_overlap(modelled(spark, d)))


@query("chance_compare", f"""WITH rows_ AS MATERIALIZED (SELECT * FROM modelled WHERE region <> '__ALL__'),
    kept AS (SELECT region, count(*) AS n_cells, count(*) FILTER (tagged) AS n_tagged, avg(activity::INT) FILTER (tagged) / nullif(avg(activity::INT), 0) AS naive FROM rows_ GROUP BY region
      HAVING count(*) >= 500 AND count(*) FILTER (tagged) >= 30), {_fitted("rows_")}
    SELECT k.region, n_cells, k.n_tagged, round(naive, 6) AS naive, round(l.above_chance_local, 6) AS local, round(f.ratio, 6) AS fitted, round(a.anchor_floor, 6) AS anchor_floor, r.ratio AS rotation, r.p AS rotation_p,
      round(l.ci_lo, 6) AS ci_lo, round(l.ci_hi, 6) AS ci_hi FROM kept k LEFT JOIN local_rows l ON l.region = k.region LEFT JOIN fitted f ON f.region = k.region
      LEFT JOIN ({_FLOOR.replace("SELECT s.region,", "SELECT s.region AS region,")}) a ON a.region = k.region LEFT JOIN ({_ROT}) r ON r.region = k.region""")
def chance_compare(spark, d):
    rows = settle_alone(spark, lambda: C.region_members(covered(spark, d), parents(spark, d)).select(*C.COMPARED), "compare")
    return tidy(C.chance_compare(rows, k=20, n_rot=200, n_boot=1000, written=True))
