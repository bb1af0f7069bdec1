"""Registered queries over the test tables, each with the same result stated in DuckDB's SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajectra.functions import shell, text
from trajectra.operators import dedup, metrics, normalize, relations, stats, turns, validate
from trajectra.views import STEPS_SQL, conversation_messages, event_steps, event_trajectories, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


# ---- scores of the events' trajectories ----

_METRICS_SQL = f"""WITH {STEPS_SQL},
chars AS (SELECT rec_id, step, unnest(string_split(output, '')) AS c FROM steps),
cc AS (SELECT rec_id, step, c, count(*) AS k FROM chars GROUP BY ALL),
ent AS (SELECT rec_id, step, log2(sum(k)) - sum(k * log2(k)) / sum(k) AS e FROM cc GROUP BY ALL),
sm AS (SELECT rec_id, step, avg(e) OVER (PARTITION BY rec_id ORDER BY step ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS s, CASE WHEN step < 5 THEN e END AS b FROM ent),
oec AS (SELECT rec_id, CASE WHEN count(*) >= 5 AND avg(b) > 0 THEN greatest(0, least(1, min(s) / avg(b))) END AS oec FROM sm GROUP BY rec_id),
iac AS (SELECT rec_id, CASE WHEN count(*) >= 3 THEN sum(CASE WHEN k % 2 = 0 AND cls IN ('read', 'bash') THEN 1 ELSE 0 END) / count(*) END AS iac FROM steps GROUP BY rec_id),
sg AS (SELECT *, CASE WHEN file IS NOT NULL THEN tool || '/' || file END AS sig, lag(CASE WHEN file IS NOT NULL THEN tool || '/' || file END) OVER w AS psig,
  lag(is_error) OVER w AS perr, lead(cls) OVER w AS ncls, lead(tool) OVER w AS ntool, lead(file) OVER w AS nfile FROM steps WINDOW w AS (PARTITION BY rec_id ORDER BY step)),
isl AS (SELECT *, sum(CASE WHEN sig IS NOT DISTINCT FROM psig AND sig IS NOT NULL THEN 0 ELSE 1 END) OVER (PARTITION BY rec_id ORDER BY step) AS island FROM sg),
runs AS (SELECT rec_id, island, count(*) AS len FROM isl WHERE sig IS NOT NULL GROUP BY ALL),
loops AS (SELECT rec_id, sum(CASE WHEN len >= 5 THEN len ELSE 0 END) / sum(len) AS loop FROM runs GROUP BY rec_id),
base AS (SELECT rec_id, count(*) AS n, sum(is_error::INT) AS errs, sum(CASE WHEN is_error AND perr THEN 1 ELSE 0 END) AS pairs, bool_or(writes) AS wrote,
  min(CASE WHEN writes THEN step + 1 END) AS first_write, min(CASE WHEN is_test THEN step END) AS first_test, min(CASE WHEN kind = 'purchase' THEN step END) AS first_fix,
  max(CASE WHEN is_test THEN step END) AS last_test, bool_or(is_test AND step + 1 >= greatest(floor(n * 0.8::DOUBLE), 1)) AS late_test,
  sum(CASE WHEN writes THEN 1 ELSE 0 END) AS edits, count(DISTINCT CASE WHEN writes THEN file END) AS files,
  avg(CASE WHEN is_error AND ntool IS NOT NULL THEN ((ntool <> tool)::INT + CASE WHEN nfile IS NULL THEN 0 ELSE 1 END) / 2 END) AS ped,
  sum(CASE WHEN step >= floor(n * 0.6::DOUBLE) THEN is_error::INT END) / count(CASE WHEN step >= floor(n * 0.6::DOUBLE) THEN 1 END) AS late_err
  FROM sg GROUP BY rec_id),
lastt AS (SELECT s.rec_id, s.k FROM steps s JOIN base b ON s.rec_id = b.rec_id AND s.step = b.last_test),
big AS (SELECT rec_id, cls, ncls, count(*) AS c FROM sg WHERE ncls IS NOT NULL GROUP BY ALL),
tte AS (SELECT rec_id, least(1, (log2(sum(c)) - sum(c * log2(c)) / sum(c)) / log2(49)) AS tte FROM big GROUP BY rec_id HAVING sum(c) >= 2),
sc AS (SELECT a.rec_id, a.step, a.n, count(DISTINCT b.file) AS scope FROM steps a JOIN steps b ON a.rec_id = b.rec_id AND b.step BETWEEN a.step - 4 AND a.step GROUP BY ALL),
late AS (SELECT * FROM sc WHERE step >= n // 2),
ken AS (SELECT a.rec_id, a.n, sum(CASE WHEN b.scope > a.scope THEN 1 ELSE 0 END) AS con, sum(CASE WHEN b.scope < a.scope THEN 1 ELSE 0 END) AS dis FROM late a JOIN late b ON a.rec_id = b.rec_id AND b.step > a.step GROUP BY ALL),
psn AS (SELECT rec_id, CASE WHEN n < 10 THEN NULL WHEN con + dis = 0 THEN 0.5 ELSE (1 - (con - dis) / (con + dis)) / 2 END AS psn FROM ken),
raw AS (SELECT b.rec_id, b.n, oec, iac, ped, psn, tte,
  greatest(0, 1 - (CASE WHEN wrote THEN 0 ELSE 0.4 END + 0.4 + least(0.3, coalesce(CASE WHEN b.n >= 5 THEN loop END, 0) * 3) + least(0.3, CASE WHEN errs > 0 THEN pairs / errs ELSE 0 END * 0.6)))::DOUBLE AS dpi,
  coalesce(CASE WHEN b.n >= 5 THEN loop END, 0)::DOUBLE AS loop, (CASE WHEN errs > 0 THEN pairs / errs ELSE 0 END)::DOUBLE AS rep,
  CASE WHEN first_write IS NULL THEN 0 WHEN first_write / b.n BETWEEN 0.2::DOUBLE AND 0.5::DOUBLE THEN 1
    ELSE exp(-(least(abs(first_write / b.n - 0.2::DOUBLE), abs(first_write / b.n - 0.5::DOUBLE)) ** 2) / 0.08::DOUBLE) END AS scp,
  CASE WHEN late_test THEN 0.15 ELSE 0 END::DOUBLE AS sub,
  CASE WHEN edits > 0 THEN 1 - greatest(0, least(1, (edits / files - 1) / 4)) END AS fec,
  (CASE WHEN b.n < 5 THEN b.n / 5 WHEN b.n <= 80 THEN 1 WHEN b.n >= 200 THEN 0 ELSE (1 - (b.n - 80) / 120) ** 1.5 END)::DOUBLE AS stp,
  (CASE WHEN last_test IS NULL THEN 0 ELSE 0.3 + 0.4 * CASE l.k % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.3 ELSE 0.6 END END)::DOUBLE AS tvr,
  CASE WHEN first_fix IS NULL THEN NULL WHEN first_test < first_fix THEN 1.0 ELSE 0.0 END::DOUBLE AS rf,
  CASE WHEN b.n >= 5 THEN 1 - late_err END AS ler, errs
  FROM base b LEFT JOIN oec USING (rec_id) LEFT JOIN iac USING (rec_id) LEFT JOIN loops USING (rec_id) LEFT JOIN psn USING (rec_id) LEFT JOIN tte USING (rec_id) LEFT JOIN lastt l ON l.rec_id = b.rec_id),
m AS (SELECT CAST(rec_id AS VARCHAR) AS rec_id, * EXCLUDE (rec_id),
  (0.33 * sub + 0.27 * stp + 0.23 * tvr + coalesce(0.1 * fec ** 5, 0) + 0.07 * dpi ** 3) / (0.33 + 0.27 + 0.23 + CASE WHEN fec IS NULL THEN 0 ELSE 0.1 END + 0.07) AS composite FROM raw)
"""


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relations.profiles(relations.steps(event_trajectories(spark, sf_dir)))


def _metric(name: str, column: str, expression, digits: int = 4) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _profiles(spark, sf_dir).select("rec_id", F.round(expression().cast("double"), digits).alias(name))

    QUERIES[name] = run
    ORACLES[name] = _METRICS_SQL + f"SELECT rec_id, round(CAST({column} AS DOUBLE), {digits}) AS {name} FROM m"


for _name, _column, _expression in (
    ("m_oec", "oec", metrics.oec), ("m_iac", "iac", metrics.iac), ("m_dpi", "dpi", metrics.dpi), ("m_ped", "ped", metrics.ped), ("m_psn", "psn", metrics.psn), ("m_tte", "tte", metrics.tte),
    ("m_scp", "scp", metrics.scp), ("m_sub", "sub", metrics.sub), ("m_fec", "fec", metrics.fec), ("m_stp", "stp", metrics.stp), ("m_tvr", "tvr", metrics.tvr),
    ("loop_fraction", "loop", metrics.loop_fraction), ("err_repeat", "rep", metrics.error_repeat), ("reproduce_first", "rf", metrics.reproduce_first), ("late_error_rate", "ler", metrics.late_error_free),
):
    _metric(_name, _column, _expression)


@query(_METRICS_SQL + "SELECT rec_id, 'opencode' AS scaffold, n AS assistant_turns, n AS total_tool_calls, " + ", ".join(f"round({c}, 4) AS {c}_score" for c in (*metrics.COMPONENTS, "composite")) + ", rf AS reproduce_first FROM m")
def score_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.scores(_profiles(spark, sf_dir))


@query(_METRICS_SQL + "SELECT rec_id, round(composite, 4) AS composite FROM m")
def composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.scores(_profiles(spark, sf_dir)).select("rec_id", F.col("composite_score").alias("composite"))


@query(_METRICS_SQL + "SELECT rec_id, n AS calls, CAST(errs AS BIGINT) AS errors FROM m")
def tool_error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.error_counts(_profiles(spark, sf_dir)).drop("scaffold")


_GROUPED = "'s' || (CAST(rec_id AS BIGINT) % 3)"


@query(_METRICS_SQL + f"""SELECT scaffold, sum(n)::BIGINT AS calls, sum(errs)::BIGINT AS errors, count(*) AS trajectories, count(*) FILTER (errs > 0) AS with_error,
  round(sum(errs) / sum(n), 6) AS error_rate, round(count(*) FILTER (errs > 0) / count(*), 6) AS trajectory_error_rate FROM (SELECT *, {_GROUPED} AS scaffold FROM m WHERE n > 0) GROUP BY ROLLUP (scaffold)""")
def tool_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = metrics.error_counts(_profiles(spark, sf_dir))
    return stats.tool_error_rate(counts.withColumn("scaffold", F.concat(F.lit("s"), (F.col("rec_id").cast("bigint") % 3).cast("string"))))


@query(_METRICS_SQL + f"""SELECT metric, scaffold, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, min(value) AS low, max(value) AS high FROM (
  SELECT {_GROUPED} AS scaffold, unnest(['sub', 'stp', 'tvr']) AS metric, unnest([round(sub, 4), round(stp, 4), round(tvr, 4)]) AS value FROM m) WHERE value IS NOT NULL GROUP BY GROUPING SETS ((metric, scaffold), (metric))""")
def score_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = metrics.scores(_profiles(spark, sf_dir)).select(F.concat(F.lit("s"), (F.col("rec_id").cast("bigint") % 3).cast("string")).alias("scaffold"), *(F.col(f"{c}_score").alias(c) for c in ("sub", "stp", "tvr")))
    return stats.score_summary(scored, ["sub", "stp", "tvr"]).withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query(f"WITH {STEPS_SQL} SELECT CAST(rec_id AS VARCHAR) AS rec_id, 2 + 2 * step AS msg_idx, 1 + 2 * step AS asst_idx, lower(tool) AS name, is_error, lower(lead(tool) OVER (PARTITION BY rec_id ORDER BY step)) AS next_name FROM steps")
def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = relations.steps(event_trajectories(spark, sf_dir)).filter("is_obs")
    return rows.select("rec_id", F.col("msg_idx").cast("bigint"), F.col("asst_idx").cast("bigint"), F.col("call.name").alias("name"), "is_error", F.col("next_call.name").alias("next_name"))


# ---- conversations ----


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = conversation_messages(spark, sf_dir)
    return m.groupBy("rec_id").agg(F.array_sort(F.collect_list(F.struct("msg_idx", "role", "content"))).alias("messages"))


_CONV = "WITH c AS (SELECT conv_id AS rec_id, turn AS msg_idx, role, text AS content, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations)"


@query(_CONV + """, b AS (SELECT *, lag(role) OVER (PARTITION BY rec_id ORDER BY msg_idx) AS p FROM c WHERE NOT (n = 1 AND role = 'system')),
v AS (SELECT rec_id, bool_and(p IS NULL OR p || '>' || role IN ('assistant>tool', 'assistant>user', 'tool>tool', 'tool>assistant', 'user>assistant')) AND arg_min(role, msg_idx) = 'user' AND arg_max(role, msg_idx) = 'assistant' AS valid FROM b GROUP BY rec_id)
SELECT DISTINCT c.rec_id, coalesce(v.valid, false) AS valid FROM c LEFT JOIN v USING (rec_id)""")
def roles_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.roles_valid_rows(conversation_messages(spark, sf_dir))


@query(ORACLES["roles_valid"])
def roles_valid_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nested(spark, sf_dir).select("rec_id", validate.roles_valid(F.col("messages")).alias("valid"))


@query(_CONV + ", r AS (SELECT rec_id, count(*) FILTER (role = 'assistant') AS rounds FROM c GROUP BY rec_id) SELECT rec_id, rounds, CASE WHEN rounds = 0 THEN 0 WHEN rounds < 5 THEN rounds / 5 WHEN rounds <= 80 THEN 1 ELSE 0 END::DOUBLE AS stp FROM r")
def rounds_stp(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = conversation_messages(spark, sf_dir).groupBy("rec_id").agg(F.count_if(F.col("role") == "assistant").alias("rounds"))
    return counted.select("rec_id", "rounds", metrics.stp(F.col("rounds")).cast("double").alias("stp"))


@query(_CONV + ", u AS (SELECT rec_id, arg_min(content, msg_idx) AS t FROM c WHERE role = 'user' AND trim(content) <> '' GROUP BY rec_id) SELECT DISTINCT c.rec_id, CASE WHEN regexp_matches(u.t, '[㐀-鿿]') THEN 'zh' ELSE 'en' END AS language FROM c LEFT JOIN u USING (rec_id)")
def language_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nested(spark, sf_dir).select("rec_id", text.infer_language(normalize.first_user_text(F.col("messages"))).alias("language"))


@query(_CONV + ", t AS (SELECT rec_id, count(*) AS turns, sum(len(list_filter(regexp_split_to_array(content, '\\s+'), lambda x: x <> '')))::BIGINT AS tokens FROM c GROUP BY rec_id) SELECT max(tokens) AS max_tokens, min(tokens) AS min_tokens, floor(avg(tokens))::BIGINT AS mean_tokens, count(*) FILTER (tokens > 131072) AS gt_128k, max(turns) AS max_turns, min(turns) AS min_turns, floor(avg(turns))::BIGINT AS mean_turns, count(*) FILTER (turns >= 100) AS gte_100, sum(tokens)::BIGINT AS total_tokens, count(*) AS n FROM t")
def token_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.size(F.filter(F.split("content", r"\s+"), lambda x: x != ""))
    return stats.token_stats(conversation_messages(spark, sf_dir).groupBy("rec_id").agg(F.count("*").alias("turns"), F.sum(words).alias("tokens")))


@query(_CONV + """, k AS (SELECT *, CASE WHEN msg_idx % 3 = 0 THEN 'user' ELSE role END AS r FROM c), i AS (SELECT *, CASE WHEN r = 'user' AND lag(r) OVER w = 'user' THEN 0 ELSE 1 END AS s FROM k WINDOW w AS (PARTITION BY rec_id ORDER BY msg_idx)),
g AS (SELECT *, sum(s) OVER (PARTITION BY rec_id ORDER BY msg_idx) AS island FROM i)
SELECT rec_id, min(msg_idx) AS msg_idx, min(r) AS role, string_agg(content, chr(10) || chr(10) ORDER BY msg_idx) AS content FROM g GROUP BY rec_id, island""")
def consecutive_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_messages(spark, sf_dir).withColumn("role", F.when(F.col("msg_idx") % 3 == 0, "user").otherwise(F.col("role")))
    return turns.merge_runs(rows, "user")


@query(_CONV + ", s AS (SELECT rec_id, bool_or(role = 'system' AND n = 1) AS has, count(*) AS k, count(*) FILTER (role = 'assistant') AS rounds FROM c GROUP BY rec_id) SELECT rec_id, '2.0.0' AS version, CASE WHEN has THEN k ELSE k + 1 END AS n_messages, rounds, 'system' AS first_role FROM s")
def im_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    fill = lambda m: F.struct(m["role"].alias("role"), F.lit(None).cast("string").alias("name"), m["content"].alias("content"), F.lit(None).cast("string").alias("reasoning_content"), F.lit(None).cast("array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>").alias("tool_calls"), F.lit(None).cast("double").alias("weight"), F.lit(None).cast("string").alias("tool_call_id"))
    records = _nested(spark, sf_dir).withColumn("messages", F.transform("messages", fill)).withColumn("tools", F.lit(None).cast("array<struct<type:string,function:struct<name:string,description:string,parameters:string>>>"))
    im = normalize.to_im(records, "2024-01-01")
    return im.select("rec_id", "version", F.size("messages").cast("bigint").alias("n_messages"), "meta_info.rounds", F.get("messages", F.lit(0))["role"].alias("first_role"))


# ---- texts of documents ----

_WIN = """CASE WHEN length(t) <= 6000 THEN t ELSE left(t, 3000) || chr(10) || CASE WHEN instr(right(t, 3000), chr(10)) BETWEEN 1 AND 300 THEN substr(right(t, 3000), instr(right(t, 3000), chr(10)) + 1) ELSE right(t, 3000) END END"""


@query(f"SELECT doc_id, md5({_WIN}) AS hash FROM (SELECT doc_id, replace(text, chr(13), '') AS t FROM documents)")
def scan_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.scan_window(F.col("text"))).alias("hash"))


@query("SELECT doc_id, md5(replace(text, chr(13), '')) AS hash FROM documents")
def strip_ansi(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.replace("text", F.lit(" "), F.lit("\x1b[01;31m \x1b[K\r"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.strip_ansi(odd)).alias("hash"))


@query("SELECT doc_id, md5(CASE WHEN length(text) > 500 THEN left(text, 250) || '~' || right(text, 250) ELSE text END) AS hash FROM documents")
def truncate_mid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.truncate_middle(F.col("text"), 500, "~")).alias("hash"))


@query("WITH x AS (SELECT doc_id, unnest(string_split(left(text, 5000), '')) AS c FROM documents), k AS (SELECT doc_id, c, count(*) AS n FROM x GROUP BY ALL) SELECT doc_id, round(log2(sum(n)) - sum(n * log2(n)) / sum(n), 6) AS entropy FROM k GROUP BY doc_id")
def char_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.round(text.char_entropy(F.col("text")), 6).alias("entropy"))


_OUTPUTS = ("3 failed, 2 passed", "3 passed in 0.2s", "0 failed", "Ran 0 tests in 0.1s\n\nOK", "bash: x: command not found", "FAIL: test_a", "test result: ok. 3 passed", "Tests run: 4, Failures: 0, Errors: 0", "Traceback (most recent call last)", "<tool_use_error>no</tool_use_error>", "exit: 0", "nothing to see")
_ERRORS = (False, False, False, False, True, False, False, False, True, True, False, False)
_OUTCOMES = ("fail", "pass", "unknown", "unknown", "fail", "fail", "pass", "pass", "fail", "fail", "pass", "unknown")
_COMMANDS = ("pytest -q", "cd a && npm test", "rm -f vitest.config.ts", "pip install pytest", "python repro.py", "FOO=1 timeout -v 10s go test ./...", "grep 'go test' x", "echo hi > out/a.py", "cat <<EOF > b_test.go", "sed -i 's/a/b/' src/x.py && ls", "tee -a log.txt", "/usr/bin/make check")
_TESTS = (True, True, False, False, True, True, False, False, False, False, False, True)
_HEADS = ("pytest", "cd", "rm", "pip", "python", "go", "grep", "echo", "cat", "sed", "tee", "make")
_EDITS = ("", "", "", "", "", "", "", "out/a.py", "b_test.go", "src/x.py", "log.txt", "")
_PATHS = ("tests/a.py", "src/test_a.py", "a_test.go", "src/Foo.java", "FooTest.java", "a.spec.ts", "conftest.py", "/testbed/x/../y.py", "repro_1.sh", "src/testing.md", "t/a.t", "Contest.java")
_IS_TEST = (True, True, True, False, True, True, True, False, True, False, True, False)
_NORMS = ("tests/a.py", "src/test_a.py", "a_test.go", "src/Foo.java", "FooTest.java", "a.spec.ts", "conftest.py", "y.py", "repro_1.sh", "src/testing.md", "t/a.t", "Contest.java")


def _pick(values: tuple) -> F.Column:
    return F.get(F.array(*(F.lit(v) for v in values)), (F.col("doc_id") % 12).cast("int"))


def _sql_pick(values: tuple) -> str:
    return "list_extract([" + ", ".join(str(v).lower() if isinstance(v, bool) else "'" + v.replace("'", "''") + "'" for v in values) + "], (doc_id % 12)::INT + 1)"


@query(f"SELECT doc_id, {_sql_pick(_ERRORS)} AS is_error, {_sql_pick(_OUTCOMES)} AS outcome FROM documents")
def test_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").withColumn("out", _pick(_OUTPUTS)).select("doc_id", text.is_error(F.col("out")).alias("is_error"), text.test_outcome(F.col("out")).alias("outcome"))


@query(f"SELECT doc_id, {_sql_pick(_TESTS)} AS test_run, {_sql_pick(_HEADS)} AS head, {_sql_pick(_EDITS)} AS edits FROM documents")
def shell_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").withColumn("cmd", _pick(_COMMANDS))
    return rows.select("doc_id", shell.is_test_run(F.col("cmd")).alias("test_run"), shell.segment_head(F.get(shell.segments(F.col("cmd")), F.lit(0))).alias("head"), F.array_join(shell.edit_paths(F.col("cmd")), ",").alias("edits"))


@query(f"SELECT doc_id, {_sql_pick(_IS_TEST)} AS is_test, {_sql_pick(_NORMS)} AS path FROM documents")
def test_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").withColumn("p", _pick(_PATHS))
    return rows.select("doc_id", shell.is_test_file(F.col("p")).alias("is_test"), shell.norm_path(F.col("p")).alias("path"))


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY source, text ORDER BY doc_id) AS n FROM documents) WHERE n = 1")
def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_exact(table(spark, sf_dir, "documents"), "source", "doc_id", "text").select("doc_id")


@query("SELECT doc_id FROM documents a WHERE NOT EXISTS (SELECT 1 FROM documents b WHERE a.source = b.source AND b.doc_id > a.doc_id AND starts_with(b.text, a.text))")
def dedup_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_prefix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "source", "doc_id", "text").select("doc_id")


@query("SELECT doc_id FROM documents WHERE len(string_split(text, chr(10))) > 2")
def dedup_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.drop_short(table(spark, sf_dir, "documents").withColumn("items", F.size(F.split("text", "\n"))), "items").select("doc_id")


@query("SELECT rec_id, CASE WHEN min(q) = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS isr, avg(q) AS csr, count(*) AS total_checks, sum(q)::BIGINT AS total_passed FROM (SELECT d.source AS rec_id, quality AS q FROM labels l JOIN documents d USING (doc_id) WHERE quality IS NOT NULL) GROUP BY rec_id")
def checklist_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = table(spark, sf_dir, "labels").filter("quality IS NOT NULL").join(table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), "doc_id")
    return stats.checklist_rewards(checks.select(F.col("source").alias("rec_id"), F.col("lang").alias("category_id"), F.col("quality").alias("score"))).drop("category_scores")


# ---- whole instances ----

_ORDERS = "SELECT o_orderkey, o_custkey, o_orderpriority LIKE '1-%' AS main, o_totalprice / 500000 AS score FROM orders"


@query(f"WITH o AS ({_ORDERS}), k AS (SELECT o_custkey FROM o WHERE main GROUP BY 1 HAVING max(score) >= 0.5) SELECT o_orderkey FROM o WHERE o_custkey IN (SELECT o_custkey FROM k)")
def filter_score_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").startswith("1-").alias("is_main"), (F.col("o_totalprice") / 500000).alias("score"))
    return validate.filter_score_bundles(rows, 0.5, instance="o_custkey").select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def keep_instance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return validate.keep_instances(rows, F.col("o_totalprice") > 450000, "o_custkey").select("o_orderkey")


@query("SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey NOT IN (0, 1)")
def repo_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "nation").withColumn("_instance_id", F.concat(F.lit("Org__Region"), F.col("n_regionkey").cast("string"), F.lit(".x-"), F.col("n_nationkey").cast("string"), F.when(F.col("n_nationkey") % 2 == 0, "__abc").otherwise("")))
    repos = table(spark, sf_dir, "region").filter("r_regionkey < 2").select(F.concat(F.lit("org/region"), F.col("r_regionkey").cast("string"), F.lit(".x")).alias("repo"))
    return validate.without_repos(ids, repos).select("n_nationkey")


@query(f"""WITH {STEPS_SQL}, t AS (SELECT *, kind = 'error' AS bad FROM steps) SELECT CAST(rec_id AS VARCHAR) AS rec_id, count(*) FILTER (NOT bad) * 2 + 1 AS kept, coalesce(max(CASE WHEN NOT bad THEN 1 + 2 * step END), 0) AS last_idx FROM t GROUP BY rec_id""")
def error_turn_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = relations.steps(event_trajectories(spark, sf_dir)).select("rec_id", "msg_idx", "role", F.when(F.col("is_error"), "<tool_use_error>x").otherwise(F.col("content")).alias("content"))
    kept = turns.drop_error_turns(rows)
    trimmed = turns.trim_trailing_tools(kept).groupBy("rec_id").agg(F.max("msg_idx").cast("bigint").alias("last_idx"))
    return kept.groupBy("rec_id").agg(F.count("*").alias("kept")).join(trimmed, "rec_id")


@query(f"""WITH {STEPS_SQL}, c AS (SELECT *, CASE WHEN step % 3 = 0 THEN 'id_' || step WHEN step % 3 = 1 THEN 'ans_' || step END AS known FROM steps)
SELECT CAST(rec_id AS VARCHAR) AS rec_id, step AS msg_idx, coalesce(known, printf('call_%06d', sum((known IS NULL)::INT) OVER (PARTITION BY rec_id ORDER BY step)::INT)) AS id FROM c""")
def id_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = event_steps(spark, sf_dir).select(F.col("rec_id").cast("string").alias("rec_id"), F.col("step").cast("bigint").alias("msg_idx"), F.lit(0).alias("pos"))
    calls = s.withColumn("id", F.when(F.col("msg_idx") % 3 == 0, F.concat(F.lit("id_"), F.col("msg_idx").cast("string"))))
    answers = s.select("rec_id", F.col("msg_idx").alias("asst_idx"), "pos", F.when(F.col("msg_idx") % 3 == 1, F.concat(F.lit("ans_"), F.col("msg_idx").cast("string"))).alias("id"))
    return turns.align_call_ids(calls, answers)[0].select("rec_id", "msg_idx", "id")
