"""I1-I20 over the driver tables: events are scores (dataset = user, method = event type, split = event_id % 5)."""

from pyspark.sql import functions as F

from tabeval.operators import benchmark
from tabeval.operators.catalog import profile
from tabeval.plans.h_metrics import rounded
from tabeval.plans.registry import Tables, query

METHODS = ["click", "error", "purchase", "signup", "view"]
SCORES_SQL = "(SELECT user_id AS dataset, event_type AS method, event_id % 5 AS split, event_id % 2 AS position, value FROM events)"
CELLS_SQL = "(SELECT user_id AS dataset, event_type AS method, avg(value) AS value FROM events GROUP BY 1, 2)"
TIMES_SQL = "(SELECT user_id AS dataset, event_type AS method, max(value) AS value FROM events GROUP BY 1, 2)"


def scores(t: Tables):
    return t.events.select(
        F.col("user_id").alias("dataset"), F.col("event_type").alias("method"), (F.col("event_id") % 5).alias("split"),
        (F.col("event_id") % 2).alias("position"), "value", "event_id",
    )


def cells(t: Tables):
    return benchmark.per_dataset(scores(t))


def times(t: Tables):
    return scores(t).groupBy("dataset", "method").agg(F.max("value").alias("value"))


def _rollup_sql(agg: str, digits: int) -> str:
    return f"""WITH c AS (SELECT method, position, dataset, {agg}(value) AS value FROM {SCORES_SQL} GROUP BY ALL),
            p AS (SELECT method, position, {agg}(value) AS value FROM c GROUP BY ALL)
       SELECT 'dataset_position' AS level, method, position, dataset, round(value, {digits}) AS value FROM c
       UNION ALL SELECT 'position', method, position, NULL, round(value, {digits}) FROM p
       UNION ALL SELECT 'dataset', method, NULL, dataset, round({agg}(value), {digits}) FROM c GROUP BY method, dataset
       UNION ALL SELECT 'overall', method, NULL, NULL, round({agg}(value), {digits}) FROM p GROUP BY method"""


@query("i01_score_rollup_mean", _rollup_sql("avg", 9))
def score_rollup_mean(t: Tables):
    return rounded(benchmark.score_rollup(scores(t)), 9)


@query("i01_score_rollup_sum", _rollup_sql("sum", 4))
def score_rollup_sum(t: Tables):
    return rounded(benchmark.score_rollup(scores(t), "sum"), 4)


@query(
    "i02_metric_matrix",
    "SELECT dataset, "
    + ", ".join(
        f"round(avg(value) FILTER (WHERE method = '{m}'), 6) AS {m}_mean, round(stddev_samp(value) FILTER (WHERE method = '{m}'), 6) AS {m}_std"
        for m in METHODS
    )
    + f" FROM (SELECT user_id AS dataset, event_type AS method, value FROM events QUALIFY row_number() OVER "
    "(PARTITION BY user_id, event_type, event_id % 5 ORDER BY event_id) = 1) GROUP BY dataset",
)
def metric_matrix(t: Tables):
    matrix = benchmark.metric_matrix(scores(t), METHODS, order=["event_id"])
    return matrix.select("dataset", *[F.round(c, 6).alias(c) for c in matrix.columns if c != "dataset"])


MASKED_SQL = f"""(SELECT dataset, c.method, CASE WHEN mean_time <= 2 * 50 THEN value END AS value FROM {CELLS_SQL} c
    JOIN (SELECT method, avg(value) AS mean_time FROM {TIMES_SQL} GROUP BY 1) m ON m.method = c.method)"""


@query("i03_time_mask", f"SELECT dataset, method, round(value, 6) AS value FROM {MASKED_SQL}")
def time_mask(t: Tables):
    return rounded(benchmark.mask_slow_methods(cells(t), times(t), 50))


FULL_SQL = f"""(SELECT d.dataset, m.method, coalesce(c.value, -1) AS value FROM (SELECT DISTINCT user_id AS dataset FROM events) d,
    (SELECT DISTINCT event_type AS method FROM events) m
    LEFT JOIN (SELECT * FROM {CELLS_SQL} WHERE value > 15) c ON c.dataset = d.dataset AND c.method = m.method)"""


@query("i04_sentinel_fill", f"SELECT dataset, method, round(value, 6) AS value FROM {FULL_SQL} f WHERE dataset IN (SELECT dataset FROM {CELLS_SQL} WHERE value > 15)")
def sentinel_fill(t: Tables):
    filled, _ = benchmark.fill_missing(cells(t).where(F.col("value") > 15), "roc", METHODS)
    return rounded(filled)


def _ranks_sql(source: str, order: str) -> str:
    return f"""(SELECT dataset, method, value, rank() OVER (PARTITION BY dataset ORDER BY round(value, 3) {order})
                 + (count(*) OVER (PARTITION BY dataset, round(value, 3)) - 1) / 2.0 AS rank FROM {source})"""


@query("i05_ranks_higher_better", f"SELECT dataset, method, CAST(rank AS DOUBLE) AS rank FROM {_ranks_sql(CELLS_SQL, 'DESC')}")
def ranks_higher(t: Tables):
    return benchmark.ranks(cells(t)).select("dataset", "method", "rank")


@query("i05_ranks_lower_better", f"SELECT dataset, method, CAST(rank AS DOUBLE) AS rank FROM {_ranks_sql(CELLS_SQL, 'ASC')}")
def ranks_lower(t: Tables):
    return benchmark.ranks(cells(t), higher_is_better=False).select("dataset", "method", "rank")


@query(
    "i06_mean_rank_and_wins",
    f"SELECT method, round(avg(rank), 6) AS mean_rank, count(*) FILTER (WHERE rank = 1) AS wins FROM {_ranks_sql(CELLS_SQL, 'DESC')} GROUP BY 1",
)
def mean_rank_and_wins(t: Tables):
    table = benchmark.ranks_and_wins(benchmark.ranks(cells(t)))
    return table.withColumn("mean_rank", F.round("mean_rank", 6))


def _wtl_sql(source: str) -> str:
    return f"""(SELECT c.method, count(*) FILTER (WHERE c.method <> 'view' AND c.value > r.value) AS wins,
      count(*) FILTER (WHERE c.method <> 'view' AND c.value = r.value) AS ties,
      count(*) FILTER (WHERE c.method <> 'view' AND c.value < r.value) AS losses
    FROM {source} c JOIN {source} r ON r.dataset = c.dataset AND r.method = 'view' GROUP BY 1)"""


@query("i07_win_tie_loss", f"SELECT * FROM {_wtl_sql(CELLS_SQL)}")
def win_tie_loss(t: Tables):
    return benchmark.win_tie_loss(cells(t), "view")


def _result_sql(metric: str, cell_sql: str, sentinel: str, order: str) -> str:
    masked = f"""(SELECT dataset, c.method, CASE WHEN mean_time <= 2 * 50 THEN value END AS value FROM {cell_sql} c
        JOIN (SELECT method, avg(value) AS mean_time FROM {TIMES_SQL} GROUP BY 1) m ON m.method = c.method)"""
    full = f"""(SELECT d.dataset, m.method, coalesce(c.value, {sentinel}) AS value FROM (SELECT DISTINCT user_id AS dataset FROM events) d,
        (SELECT DISTINCT event_type AS method FROM events) m LEFT JOIN {masked} c ON c.dataset = d.dataset AND c.method = m.method)"""
    ranked = f"""SELECT method, avg(rank) AS mean_rank, CAST(count(*) FILTER (WHERE rank = 1) AS DOUBLE) AS wins
        FROM {_ranks_sql(full, order)} GROUP BY 1"""
    return f"""SELECT method, 'default' AS ranking, round(avg(value), 6) AS value, '{metric}' AS metric FROM {cell_sql} GROUP BY 1
        UNION ALL SELECT method, 'rank_', round(mean_rank, 6), '{metric}' FROM ({ranked})
        UNION ALL SELECT method, 'wins_', wins, '{metric}' FROM ({ranked})"""


@query(
    "i08_result_table",
    f"""SELECT x.*, round(real_time, 6) AS real_time, 50.0::DOUBLE AS time, 1 AS split_number FROM (
          {_result_sql('roc', CELLS_SQL, '-1', 'DESC')} UNION ALL {_result_sql('cross_entropy', TIMES_SQL, '100', 'ASC')}) x
        JOIN (SELECT method, avg(value) AS real_time FROM {TIMES_SQL} GROUP BY 1) r ON r.method = x.method""",
)
def result_table(t: Tables):
    table = benchmark.result_table({"roc": cells(t), "cross_entropy": times(t)}, times(t), METHODS, 50, 1)
    return rounded(table).withColumn("real_time", F.round("real_time", 6))


def _pivoted(sql: str) -> str:
    columns = ", ".join(f"max(text) FILTER (WHERE method = '{m}') AS \"{m}\"" for m in METHODS)
    return f"SELECT \"row\", {columns} FROM ({sql}) GROUP BY 1"


@query(
    "i09_summary_table",
    _pivoted(
        f"""SELECT method, dataset::VARCHAR AS "row", printf('%.3f', value) AS text FROM {TIMES_SQL}
        UNION ALL SELECT method, 'Wins', (count(*) FILTER (WHERE rank = 1))::VARCHAR FROM {_ranks_sql(TIMES_SQL, 'DESC')} GROUP BY 1
        UNION ALL SELECT method, 'Mean rank', printf('%.3f', avg(rank)) FROM {_ranks_sql(TIMES_SQL, 'DESC')} GROUP BY 1
        UNION ALL SELECT method, 'Win/T/L vs reference', wins || '/' || ties || '/' || losses FROM {_wtl_sql(TIMES_SQL)}
        UNION ALL SELECT method, 'Mean', printf('%.3f', avg(value)) FROM {TIMES_SQL} GROUP BY 1
        UNION ALL SELECT method, 'Mean std', printf('%.3f', avg(s)) FROM (SELECT method, dataset, stddev_samp(value) AS s FROM {SCORES_SQL} GROUP BY ALL) GROUP BY 1
        UNION ALL SELECT method, 'Mean time (s)', printf('%.3f', avg(value)) FROM {TIMES_SQL} GROUP BY 1"""
    ),
)
def summary_table(t: Tables):
    return benchmark.summary_table(times(t), scores(t), times(t), METHODS, "view")


@query(
    "i10_best_flags",
    f"SELECT dataset, method, round(value, 3) = max(round(value, 3)) OVER (PARTITION BY dataset) AS is_best FROM {CELLS_SQL}",
)
def best_flags(t: Tables):
    return benchmark.best_flags(cells(t)).drop("value")


@query(
    "i11_label_conflicts",
    """SELECT l_orderkey, l_linenumber, min(y) AS low, max(y) AS high FROM (
         SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem) GROUP BY 1, 2 HAVING min(y) <> max(y)""",
)
def label_conflicts(t: Tables):
    # line items that repeat an order and line number stand for two methods' copies of one row
    rows = t.lineitem.withColumn("y", F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
    return benchmark.label_conflicts(rows, ["l_orderkey", "l_linenumber"], "y")


@query(
    "i12_result_dump",
    "SELECT dataset, "
    + ", ".join(f"round(max(c) FILTER (WHERE method = '{m}'), 6) AS {m}_roc, round(max(x) FILTER (WHERE method = '{m}'), 6) AS {m}_time" for m in METHODS)
    + """, max(number_of_rows) AS number_of_rows, max(number_of_classes) AS number_of_classes FROM (
          SELECT user_id AS dataset, event_type AS method, avg(value) AS c, max(value) AS x FROM events GROUP BY 1, 2)
        JOIN (SELECT user_id, count(*) AS number_of_rows, count(DISTINCT event_type) AS number_of_classes FROM events GROUP BY 1) ON user_id = dataset
        GROUP BY dataset""",
)
def result_dump(t: Tables):
    facts = profile(t.events.withColumnRenamed("user_id", "dataset"), ["value"], "event_type", ["dataset"])
    dump = benchmark.result_dump(
        {"roc": cells(t), "time": times(t)}, METHODS, facts.select("dataset", "number_of_rows", "number_of_classes")
    )
    return dump.select(*[F.round(c, 6).alias(c) if c.endswith(("_roc", "_time")) else c for c in dump.columns])


WIDE_SQL = """(SELECT user_id % 3 AS budget, user_id, avg(value) FILTER (WHERE event_type = 'view') AS view,
    avg(value) FILTER (WHERE event_type = 'click') AS click FROM events GROUP BY 1, 2)"""


def wide(t: Tables):
    mean_of = lambda m: F.avg(F.when(F.col("event_type") == m, F.col("value"))).alias(m)
    return t.events.groupBy((F.col("user_id") % 3).alias("budget"), "user_id").agg(mean_of("view"), mean_of("click"))


@query(
    "i13_difference_table",
    f"""SELECT budget, model, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS stdv, round(median(value), 6) AS median
        FROM (SELECT budget, view, click, view - click AS diff FROM {WIDE_SQL}) UNPIVOT (value FOR model IN (view, click, diff)) GROUP BY 1, 2""",
)
def difference_table(t: Tables):
    table = benchmark.difference_table(wide(t), "view", "click", ["budget"])
    return table.withColumns({c: F.round(c, 6) for c in ("mean", "stdv", "median")})


@query(
    "i14_winner",
    f"SELECT user_id, view > click AS win, CASE WHEN view > click THEN 'view' ELSE 'click' END AS winner FROM {WIDE_SQL} WHERE view IS NOT NULL AND click IS NOT NULL",
)
def winner(t: Tables):
    return benchmark.with_winner(wide(t), "view", "click").select("user_id", "win", "winner")


@query(
    "i14_win_count",
    f"SELECT winner, count(*) AS n FROM (SELECT CASE WHEN view > click THEN 'view' ELSE 'click' END AS winner FROM {WIDE_SQL} WHERE view IS NOT NULL AND click IS NOT NULL) GROUP BY 1",
)
def win_count(t: Tables):
    return benchmark.with_winner(wide(t), "view", "click").groupBy("winner").agg(F.count(F.lit(1)).alias("n"))


@query(
    "i15_signed_rank",
    """SELECT l_returnflag, v, n, round((v - n * (n + 1) / 4) / sqrt(n * (n + 1) * (2 * n + 1) / 24 - ties / 48), 6) AS z FROM (
         SELECT l_returnflag, sum(CASE WHEN d > 0 THEN r ELSE 0 END) AS v, count(*) AS n FROM (
           SELECT l_returnflag, d, rank() OVER (PARTITION BY l_returnflag ORDER BY abs(d))
             + (count(*) OVER (PARTITION BY l_returnflag, abs(d)) - 1) / 2 AS r
           FROM (SELECT l_returnflag, round(l_discount - l_tax, 6) AS d FROM lineitem) WHERE d <> 0) GROUP BY 1)
       JOIN (SELECT l_returnflag, sum(c * c * c - c) AS ties FROM (
           SELECT l_returnflag, abs(round(l_discount - l_tax, 6)) AS a, count(*)::DOUBLE AS c FROM lineitem
           WHERE round(l_discount - l_tax, 6) <> 0 GROUP BY 1, 2) GROUP BY 1) USING (l_returnflag)""",
)
def signed_rank(t: Tables):
    test = benchmark.signed_rank_test(t.lineitem, ["l_returnflag"], "l_discount", "l_tax", digits=6)
    one = test.where(F.col("alternative") == "two.sided")
    return one.select("l_returnflag", "v", "n", F.round("z", 6).alias("z"))


def _normal_tail_sql(z: str) -> str:
    """P(Z > z) by the series of the error function that has positive terms only; beyond 8.5 deviations it is 0."""
    x = f"(abs({z}) / sqrt(2))"
    erf = f"list_sum(list_transform(range(0, 150), lambda k: exp((2 * k + 1) * ln(greatest({x}, 1e-300)) - lgamma(k + 1.5) - {x} * {x})))"
    return f"(0.5 - 0.5 * sign({z}) * CASE WHEN {x} > 6 THEN 1.0 ELSE {erf} END)"


def _alternatives_sql(source: str, keys: str) -> str:
    """p-values of (keys, gap, sigma) for the three alternatives, normal with continuity correction."""
    return f"""SELECT {keys}, alternative, round(CASE alternative
          WHEN 'greater' THEN {_normal_tail_sql("((gap - 0.5) / sigma)")}
          WHEN 'less' THEN {_normal_tail_sql("(-(gap + 0.5) / sigma)")}
          ELSE least(1.0, 2 * {_normal_tail_sql("(abs((gap - 0.5 * sign(gap)) / sigma))")}) END, 6) AS p_value
        FROM {source}, (VALUES ('two.sided'), ('greater'), ('less')) a(alternative)"""


def _signed_rank_sql(group: str, gap: str) -> str:
    """Rank sums of the positive differences with what their tests need."""
    return f"""(SELECT {group}, v, n, zeros, largest, v - n * (n + 1) / 4 AS gap, sqrt(n * (n + 1) * (2 * n + 1) / 24 - ties / 48) AS sigma FROM (
         SELECT {group}, sum(CASE WHEN d > 0 THEN r ELSE 0 END)::DOUBLE AS v, count(*) AS n, sum(c * c - 1)::DOUBLE AS ties, max(c) AS largest FROM (
           SELECT {group}, d, rank() OVER (PARTITION BY {group} ORDER BY abs(d)) + (count(*) OVER (PARTITION BY {group}, abs(d)) - 1) / 2 AS r,
             count(*) OVER (PARTITION BY {group}, abs(d)) AS c
           FROM (SELECT *, {gap} AS d FROM lineitem) WHERE d <> 0) GROUP BY ALL)
       JOIN (SELECT {group}, count_if({gap} = 0)::BIGINT AS zeros FROM lineitem GROUP BY ALL) USING ({group}))"""


@query(
    "i15_signed_rank_p_values",
    _alternatives_sql(f"(SELECT *, round(gap / sigma, 6) AS z FROM {_signed_rank_sql('l_linestatus, l_linenumber', 'round(l_discount - l_tax, 6)')})", "l_linestatus, l_linenumber, v, n, zeros, z"),
)
def signed_rank_p_values(t: Tables):
    test = benchmark.signed_rank_test(t.lineitem, ["l_linestatus", "l_linenumber"], "l_discount", "l_tax", digits=6)
    return test.withColumns({"z": F.round("z", 6), "p_value": F.round("p_value", 6)})


@query(
    "i15_signed_rank_small",
    f"""WITH RECURSIVE sums(k, s, c) AS (
          SELECT 0, 0, 1.0::DOUBLE UNION ALL SELECT k + 1, s2, sum(c) FROM (SELECT k, s AS s2, c FROM sums UNION ALL SELECT k, s + k + 1, c FROM sums) WHERE k < 49 GROUP BY k, s2
        ), share AS (
          SELECT k, s, sum(c) OVER (PARTITION BY k ORDER BY s) / pow(2, k) AS low, c / pow(2, k) AS here FROM sums
        ), tested AS ({_signed_rank_sql("l_partkey", "round(l_extendedprice - 1000 * l_quantity, 2)")}
        ), exact AS (
          SELECT l_partkey, v, n, low, 1 - low + here AS high FROM tested JOIN share ON k = n AND s = v WHERE largest = 1 AND zeros = 0 AND n < 50
        )
        SELECT l_partkey, v, n, alternative, round(CASE alternative WHEN 'less' THEN low WHEN 'greater' THEN high ELSE least(1.0, 2 * least(low, high)) END, 6) AS p_value
        FROM exact, (VALUES ('two.sided'), ('greater'), ('less')) a(alternative)
        UNION ALL {_alternatives_sql("(SELECT * FROM tested WHERE largest > 1 OR zeros > 0 OR n >= 50)", "l_partkey, v, n")}""",
)
def signed_rank_small(t: Tables):
    """Groups on both sides of 50 pairs: the exact distribution of the rank sum, or the normal one."""
    rows = t.lineitem.select("l_partkey", "l_extendedprice", (F.col("l_quantity") * 1000).alias("expected"))
    test = benchmark.signed_rank_test(rows, ["l_partkey"], "l_extendedprice", "expected", digits=2)
    return test.select("l_partkey", "v", "n", "alternative", F.round("p_value", 6).alias("p_value"))


@query(
    "i16_rank_sum",
    """SELECT l_returnflag, w, n_x, n_y, round((w - n_x * n_y / 2) / sqrt(n_x * n_y / 12 * ((n_x + n_y + 1) - ties / ((n_x + n_y) * (n_x + n_y - 1.0)))), 6) AS z FROM (
         SELECT l_returnflag, sum(CASE WHEN x THEN r ELSE 0 END) - count(*) FILTER (WHERE x) * (count(*) FILTER (WHERE x) + 1) / 2 AS w,
           count(*) FILTER (WHERE x) AS n_x, count(*) FILTER (WHERE NOT x) AS n_y FROM (
           SELECT l_returnflag, l_linestatus = 'F' AS x, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity)
             + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2 AS r FROM lineitem) GROUP BY 1)
       JOIN (SELECT l_returnflag, sum(c * c * c - c) AS ties FROM (
           SELECT l_returnflag, l_quantity, count(*)::DOUBLE AS c FROM lineitem GROUP BY 1, 2) GROUP BY 1) USING (l_returnflag)""",
)
def rank_sum(t: Tables):
    test = benchmark.rank_sum_test(t.lineitem, ["l_returnflag"], F.col("l_linestatus") == "F", "l_quantity")
    one = test.where(F.col("alternative") == "two.sided")
    return one.select("l_returnflag", "w", "n_x", "n_y", F.round("z", 6).alias("z"))


@query(
    "i16_rank_sum_p_values",
    _alternatives_sql(
        """(SELECT *, w - n_x * n_y / 2 AS gap, round((w - n_x * n_y / 2) / sigma, 6) AS z FROM (
             SELECT *, sqrt(n_x * n_y / 12 * ((n_x + n_y + 1) - ties / ((n_x + n_y) * (n_x + n_y - 1.0)))) AS sigma FROM (
               SELECT l_linenumber, sum(CASE WHEN x THEN r ELSE 0 END)::DOUBLE - count_if(x) * (count_if(x) + 1) / 2 AS w, count_if(x)::BIGINT AS n_x, count_if(NOT x)::BIGINT AS n_y,
                 sum(c * c - 1)::DOUBLE AS ties FROM (
                 SELECT l_linenumber, l_linestatus = 'F' AS x, rank() OVER (PARTITION BY l_linenumber ORDER BY l_extendedprice)
                   + (count(*) OVER (PARTITION BY l_linenumber, l_extendedprice) - 1) / 2 AS r, count(*) OVER (PARTITION BY l_linenumber, l_extendedprice) AS c FROM lineitem) GROUP BY 1)))""",
        "l_linenumber, w, n_x, n_y, z",
    ),
)
def rank_sum_p_values(t: Tables):
    test = benchmark.rank_sum_test(t.lineitem, ["l_linenumber"], F.col("l_linestatus") == "F", "l_extendedprice")
    return test.withColumns({"z": F.round("z", 6), "p_value": F.round("p_value", 6)})


@query(
    "i17_one_way_variance",
    """SELECT df_between, df_within, round(ss_between / 1e6, 4) AS ss_between, round(ss_within / 1e6, 4) AS ss_within,
         round((ss_between / df_between) / (ss_within / df_within), 6) AS f_value FROM (
         SELECT count(*) - 1 AS df_between, CAST(sum(n) - count(*) AS BIGINT) AS df_within, sum(n * (mean - grand) ** 2) AS ss_between, sum(ss) AS ss_within FROM (
           SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS mean, var_pop(o_totalprice) * count(*) AS ss,
             (SELECT avg(o_totalprice) FROM orders) AS grand FROM orders GROUP BY 1))""",
)
def one_way_variance(t: Tables):
    table = benchmark.one_way_variance(t.orders, "o_orderpriority", "o_totalprice")
    in_millions = {c: F.round(F.col(c) / 1e6, 4) for c in ("ss_between", "ss_within")}
    return table.withColumns(in_millions).withColumn("f_value", F.round("f_value", 6))


FACTORS = {"l_quantity": "l_quantity", "returned": "l_returnflag = 'R'", "l_linenumber": "l_linenumber", "l_extendedprice": "l_extendedprice"}


def _sequential_sql(factors: dict[str, str], y: str) -> str:
    """Each factor is taken out of the later ones and of y in turn; what it takes out of y is its sum of squares."""
    names = [f"f{i}" for i in range(len(factors))] + ["y"]
    kept = ", ".join(f"({e})::INTEGER::DOUBLE AS {n}" if "=" in e or ">" in e else f"({e})::DOUBLE AS {n}" for n, e in zip(names, [*factors.values(), y]))
    parts = [f"WITH given AS (SELECT {kept} FROM lineitem), r0 AS MATERIALIZED (SELECT {', '.join(f'{n} - avg({n}) OVER () AS {n}' for n in names)} FROM given)"]
    for i in range(len(factors)):
        here, later = f"f{i}", names[i + 1 :]
        parts.append(f", m{i} AS MATERIALIZED (SELECT {', '.join(f'sum({here} * {n}) / sum({here} * {here}) AS k_{n}' for n in later)}, sum({here} * y) * sum({here} * y) / sum({here} * {here}) AS ss FROM r{i})")
        parts.append(f", r{i + 1} AS MATERIALIZED (SELECT {', '.join(f'{n} - k_{n} * {here} AS {n}' for n in later)} FROM r{i}, m{i})")
    last = len(factors)
    parts.append(f", rest AS (SELECT sum(y * y) AS ss, count(*) - {last + 1} AS free, sum(y * y) / (count(*) - {last + 1}) AS scale FROM r{last})")
    rows = " UNION ALL ".join(f"SELECT '{name}' AS factor, m{i}.ss AS ss, m{i}.ss / scale AS f, free, m{i}.ss / scale / (free + m{i}.ss / scale) AS u FROM m{i}, rest" for i, name in enumerate(factors))
    # the share of F(1, free) below f as a series of positive terms; far out nothing is left
    series = "1 + list_sum(list_transform(range(0, 400), lambda k: exp(lgamma(1.5) + lgamma(1.5 + free / 2 + k) - lgamma(2.5 + k) - lgamma(0.5 + free / 2) + (k + 1) * ln(u))))"
    front = "exp(0.5 * ln(u) + free / 2 * ln(1 - u) + lgamma(0.5 + free / 2) - lgamma(1.5) - lgamma(free / 2))"
    return "".join(parts) + f"""
SELECT factor, 1 AS df, round(ss, 6) AS sum_sq, round(ss, 6) AS mean_sq, round(f, 6) AS f_value, round(CASE WHEN f > 100 THEN 0.0 ELSE 1 - {front} * ({series}) END, 6) AS p_value FROM ({rows})
UNION ALL SELECT 'Residuals', free::INTEGER, round(ss, 6), round(scale, 6), NULL, NULL FROM rest"""


@query("i17_sequential_variance", _sequential_sql(FACTORS, "l_discount > l_tax"))
def sequential_variance(t: Tables):
    win = (F.col("l_discount") > F.col("l_tax")).cast("int")
    rows = t.lineitem.withColumn("win", win).withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))
    table = benchmark.sequential_variance(rows, list(FACTORS), "win")
    return table.withColumns({c: F.round(c, 6) for c in ("sum_sq", "mean_sq", "f_value", "p_value")})


@query(
    "i17_sequential_variance_two_factors",
    """WITH f AS (SELECT count(*) AS n, var_pop(l_extendedprice) * count(*) AS total, corr(l_extendedprice, l_quantity) AS a,
                   corr(l_extendedprice, l_tax) AS b, corr(l_quantity, l_tax) AS c FROM lineitem),
            s AS (SELECT n, total, total * a * a AS s1, total * (a * a + b * b - 2 * a * b * c) / (1 - c * c) AS s12 FROM f)
       SELECT 'l_quantity' AS factor, 1 AS df, round(s1 / 1e9, 6) AS sum_sq, round(s1 / ((total - s12) / (n - 3)), 6) AS f_value FROM s
       UNION ALL SELECT 'l_tax', 1, round((s12 - s1) / 1e9, 6), round((s12 - s1) / ((total - s12) / (n - 3)), 6) FROM s
       UNION ALL SELECT 'Residuals', CAST(n - 3 AS INTEGER), round((total - s12) / 1e9, 6), NULL FROM s""",
)
def sequential_variance_two_factors(t: Tables):
    table = benchmark.sequential_variance(t.lineitem, ["l_quantity", "l_tax"], "l_extendedprice")
    return table.select("factor", "df", F.round(F.col("sum_sq") / 1e9, 6).alias("sum_sq"), F.round("f_value", 6).alias("f_value"))


@query(
    "i18_five_number_summary",
    "SELECT l_returnflag, "
    + ", ".join(f"round(quantile_cont(l_extendedprice, {p}), 4) AS {n}" for n, p in benchmark.FIVE_NUMBERS.items())
    + " FROM lineitem GROUP BY 1",
)
def five_number_summary(t: Tables):
    table = benchmark.five_number_summary(t.lineitem, ["l_returnflag"], "l_extendedprice")
    return table.select("l_returnflag", *[F.round(c, 4).alias(c) for c in benchmark.FIVE_NUMBERS])


@query(
    "i18_trimmed_range",
    """SELECT l_returnflag, l_extendedprice FROM lineitem JOIN (SELECT l_returnflag AS f, quantile_cont(l_extendedprice, 0.1) AS low,
         quantile_cont(l_extendedprice, 0.9) AS high FROM lineitem GROUP BY 1) ON f = l_returnflag WHERE l_extendedprice BETWEEN low AND high""",
)
def trimmed_range(t: Tables):
    return benchmark.trimmed(t.lineitem.select("l_returnflag", "l_extendedprice"), ["l_returnflag"], "l_extendedprice")


@query(
    "i19_leaderboard",
    f"""SELECT dataset, method, metric, round(value, 6) AS value FROM (
          SELECT *, CASE WHEN dataset % 3 = 0 THEN 'r2' ELSE 'roc_auc' END AS metric FROM {CELLS_SQL})
        QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY value DESC, method) = 1""",
)
def leaderboard(t: Tables):
    kind = F.when(F.col("dataset") % 3 == 0, "regression").when(F.col("dataset") % 3 == 1, "binary").otherwise("multiclass")
    both = cells(t).withColumn("problem_type", kind).withColumn("metric", F.explode(F.array(F.lit("r2"), F.lit("roc_auc"))))
    return rounded(benchmark.leaderboard(both).drop("problem_type"))


@query(
    "i20_budget_curves",
    """WITH r AS (SELECT event_type AS method, [1.0, 5.0, 30.0, 60.0][1 + event_id % 4]::DOUBLE AS time, value, value + 1 AS real_time FROM events),
            f AS (SELECT * FROM r WHERE method <> 'error' OR time >= 30),
            u AS (SELECT * FROM f UNION ALL SELECT method, 300.0, value, 300.0 FROM f WHERE method IN ('click', 'signup') AND time = 60)
       SELECT method, time, round(CASE WHEN method = 'view' THEN (SELECT avg(value) FROM f WHERE method = 'view') ELSE avg(value) END, 6) AS value,
         round(avg(real_time), 6) AS real_time, round(log10(time), 6) AS time_log,
         round(CASE WHEN method = 'view' THEN 0 ELSE log10(avg(real_time)) END, 6) AS real_time_log FROM u GROUP BY 1, 2""",
)
def budget_curves(t: Tables):
    time = F.get(F.array(*[F.lit(x) for x in (1.0, 5.0, 30.0, 60.0)]), (F.col("event_id") % 4).cast("int"))
    runs = t.events.select(F.col("event_type").alias("method"), time.alias("time"), "value", (F.col("value") + 1).alias("real_time"))
    curve = benchmark.budget_curves(runs, {"error": 30}, ["click", "signup"], 60, 300, collapse="view")
    return curve.withColumns({c: F.round(c, 6) for c in ("value", "real_time", "time_log", "real_time_log")})
