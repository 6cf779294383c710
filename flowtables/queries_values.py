"""Registered queries: settings with defaults (P7–P11), string and date
functions (F1–F8, F10–F12), profiles (J2) and overlays (W5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bindings as B
from .constants import VAR_PREFIX
from .functions import dates as D
from .functions import settings as S
from .functions import spark_conf as SC
from .functions import text as X
from .operators import lookup
from .queries import register

_SETTINGS_SQL = """
WITH s AS (
  SELECT c_custkey, c_name, c_mktsegment, c_nationkey,
         CASE WHEN c_custkey % 3 = 0 THEN 'absent' WHEN c_custkey % 3 = 1 THEN 'null' ELSE 'set' END AS rn_state,
         CAST(round(c_acctbal * 100) AS BIGINT) AS cents
  FROM customer)
"""


@register(
    "p7_with_defaults",
    _SETTINGS_SQL
    + """
SELECT c_custkey,
  CASE rn_state WHEN 'absent' THEN 'default-run' WHEN 'null' THEN NULL ELSE c_mktsegment END AS run_name,
  CAST(cents AS VARCHAR) AS acctbal, 'none' AS description
FROM s
""",
)
def p7_with_defaults(spark, sf_dir):
    st = B.settings(spark, sf_dir)
    return S.with_defaults(st, "conf", {"run_name": "default-run", "acctbal": "0", "description": "none"}).select(
        "c_custkey", "run_name", "acctbal", "description"
    )


@register(
    "p8_require_keys",
    """
SELECT c_custkey, 'run_name' AS key, 'Missing required configuration: ''run_config.run_name''.' AS message
FROM customer WHERE c_custkey % 3 = 0
""",
)
def p8_require_keys(spark, sf_dir):
    st = B.settings(spark, sf_dir)
    return S.missing_keys(st, "c_custkey", "conf", ["experiment_name", "run_name", "acctbal"], prefix="run_config.")


@register(
    "p9_dependent_default",
    _SETTINGS_SQL
    + """
SELECT c_custkey, CASE rn_state WHEN 'absent' THEN c_name WHEN 'null' THEN NULL ELSE c_mktsegment END AS run_name
FROM s
""",
)
def p9_dependent_default(spark, sf_dir):
    st = B.settings(spark, sf_dir)
    return st.select("c_custkey", S.dependent_default("conf", "run_name", "experiment_name", "run_config.").alias("run_name"))


@register(
    "p10_truthy_or_empty",
    _SETTINGS_SQL
    + """
SELECT c_custkey,
  CASE rn_state WHEN 'set' THEN c_mktsegment ELSE '' END AS run_name_text,
  CASE WHEN c_nationkey = 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS nation_text,
  CAST(CASE rn_state WHEN 'set' THEN 3 ELSE 2 END AS INTEGER) AS n_truthy
FROM s
""",
)
def p10_truthy_or_empty(spark, sf_dir):
    st = B.settings(spark, sf_dir)
    return st.select(
        "c_custkey",
        S.truthy_or_empty(S.setting("conf", "run_name")).alias("run_name_text"),
        S.truthy_or_empty_number("c_nationkey").alias("nation_text"),
        F.size(S.truthy_map("conf")).alias("n_truthy"),
    )


@register(
    "p11_first_set",
    _SETTINGS_SQL
    + """
SELECT c_custkey,
  coalesce(CASE rn_state WHEN 'set' THEN c_mktsegment END,
           CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END, 'AUTOMATIC') AS chosen
FROM s
""",
)
def p11_first_set(spark, sf_dir):
    st = B.settings(spark, sf_dir)
    env = F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise(F.lit(""))
    return st.select("c_custkey", S.first_set(S.setting("conf", "run_name"), env, default="AUTOMATIC").alias("chosen"))


# --------------------------------------------------------------------------
# Strings.

def _slug_sql(expr: str) -> str:
    """Slug in SQL, written from the rule and not from the implementation."""
    spelled = (
        f"replace(replace(replace(replace(replace(replace(replace({expr}, 'ß', 'ss'), 'œ', 'oe'), 'Œ', 'oe'),"
        " 'æ', 'ae'), 'Æ', 'ae'), 'ø', 'o'), 'ł', 'l')"
    )
    lowered = f"lower(strip_accents({spelled}))"
    # Digits lose the comma between them; twice, since a digit can end one match and begin the next.
    joined = f"regexp_replace(regexp_replace({lowered}, '([0-9]),([0-9])', '\\1\\2', 'g'), '([0-9]),([0-9])', '\\1\\2', 'g')"
    return f"trim(regexp_replace({joined}, '[^a-z0-9]+', '-', 'g'), '-')"


@register("f1_slugify", f"SELECT doc_id, {_slug_sql('text')} AS slug FROM documents")
def f1_slugify(spark, sf_dir):
    d = B.table(spark, sf_dir, "documents")
    return d.select("doc_id", X.slugify("text").alias("slug"))


@register(
    "f2_run_scoped_name",
    f"""
SELECT o_orderkey, {_slug_sql('o_orderpriority')} || '.' || lower(strftime(o_orderdate, '%Y%m%dT%H%M%S')) AS run_area
FROM orders
""",
)
def f2_run_scoped_name(spark, sf_dir):
    o = B.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", X.run_scoped_name("o_orderpriority", "o_orderdate").alias("run_area"))


_AS_OF_F3 = "2024-06-01"


@register(
    "f3_start_date",
    f"""
SELECT o_orderkey,
  CASE WHEN o_orderkey % 7 IN (0, 1, 3) THEN DATE '{_AS_OF_F3}' - INTERVAL 2 DAY ELSE CAST(o_orderdate AS DATE) END::DATE
    AS start_date
FROM orders
""",
)
def f3_start_date(spark, sf_dir):
    o = B.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 7
    raw = (
        F.when(k == 0, F.lit(None).cast("string"))
        .when(k == 1, F.lit(""))
        .when(k == 2, F.date_format("o_orderdate", "yyyyMMdd").cast("int").cast("string"))
        .when(k == 3, F.lit("  "))
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    )
    return o.select("o_orderkey", D.start_date(raw, F.lit(_AS_OF_F3)).alias("start_date"))


@register(
    "f4_run_macros",
    """
SELECT pipeline_id, strftime(execution_ts, '%Y-%m-%d') AS ds,
  strftime(lag(execution_ts) OVER (PARTITION BY pipeline_id ORDER BY execution_ts), '%Y-%m-%d') AS prev_ds,
  strftime(execution_ts, '%Y%m%dT%H%M%S') AS ts_nodash
FROM (SELECT DISTINCT o_custkey AS pipeline_id, o_orderdate AS execution_ts FROM orders)
""",
)
def f4_run_macros(spark, sf_dir):
    from .operators.runs import previous_run

    prev = previous_run(B.runs(spark, sf_dir))
    return D.run_macros(prev, "execution_ts", "prev_ts").select("pipeline_id", "ds", "prev_ds", "ts_nodash")


@register(
    "f5_render_params",
    """
WITH p AS (
  SELECT o_orderkey,
    'ds:' || strftime(o_orderdate, '%Y-%m-%d') || ',priority:' || o_orderpriority || ',status:' || CASE WHEN o_orderkey % 5 = 0 THEN 'None' ELSE o_orderstatus END
      || ',ts:' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS params,
    o_orderpriority, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ts_back
  FROM orders)
SELECT o_orderkey, params, o_orderpriority AS priority_back, regexp_extract(params, 'status:([^,]*)', 1) AS status_back,
  ts_back, 4 AS n_pairs FROM p
""",
)
def f5_render_params(spark, sf_dir):
    o = B.table(spark, sf_dir, "orders")
    m = F.create_map(
        F.lit("ds"), F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.lit("priority"), F.col("o_orderpriority"),
        F.lit("status"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")),
        F.lit("ts"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
    )
    rendered = o.select("o_orderkey", X.render_params(m).alias("params"))
    # The step reads them back from padded text, as a rendered command would hold them.
    padded = F.concat(F.lit("\n    status:earlier,\n    "), F.regexp_replace("params", ",", ",\n    "), F.lit(",\n  "))
    back = rendered.withColumn("_m", X.parse_params(padded))
    return back.select(
        "o_orderkey",
        "params",
        F.col("_m")["priority"].alias("priority_back"),
        F.col("_m")["status"].alias("status_back"),
        F.col("_m")["ts"].alias("ts_back"),
        F.size("_m").alias("n_pairs"),
    )


_MESSAGE = "Task {task} in {dag} failed at {execution_time}. Log: {url}"


@register(
    "f6_render_message",
    """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_linenumber % 4 = 0 THEN 'Task failed!'
       ELSE 'Task task-{dag}-' || l_linenumber || ' in run-' || l_orderkey || ' failed at '
            || strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') || '. Log: http://scheduler/log?run=run-' || l_orderkey
            || '&task=task-{dag}-' || l_linenumber END AS message
FROM lineitem WHERE l_returnflag = 'R'
""",
)
def f6_render_message(spark, sf_dir):
    from .constants import DEFAULT_FAILURE_MESSAGE

    li = B.table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    task = F.concat(F.lit("task-{dag}-"), F.col("l_linenumber").cast("string"))
    dag = F.concat(F.lit("run-"), F.col("l_orderkey").cast("string"))
    template = F.when(F.col("l_linenumber") % 4 != 0, F.lit(_MESSAGE))
    fields = {
        "task": task,
        "dag": dag,
        "execution_time": F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"),
        "url": F.concat(F.lit("http://scheduler/log?run="), dag, F.lit("&task="), task),
    }
    return li.select("l_orderkey", "l_linenumber", X.render_message(template, fields, DEFAULT_FAILURE_MESSAGE).alias("message"))


@register(
    "f7_substitute",
    """
SELECT p_partkey,
  'store/' || coalesce(CASE WHEN p_partkey % 2 = 0 THEN '${shape}' || p_brand END, 'plain') || '/' || p_type || '/'
  || coalesce(CASE WHEN p_partkey % 3 = 0 THEN lower(p_type) || '$1' END, 'round') || '/${unset.var}' AS resolved
FROM part
""",
)
def f7_substitute(spark, sf_dir):
    """Values hold placeholders and signs of their own, which stay as they are."""
    p = B.table(spark, sf_dir, "part")
    text = F.concat(F.lit("store/${colour|plain}/"), F.col("p_type"), F.lit("/${shape|round}/${unset.var}"))
    variables = F.create_map(
        F.lit("colour"), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("${shape}"), "p_brand")),
        F.lit("shape"), F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lower("p_type"), F.lit("$1"))),
    )
    return p.select("p_partkey", X.substitute(text, variables).alias("resolved"))


@register(
    "f8_prefixed_vars",
    """
SELECT event_id,
  CASE WHEN event_type = 'purchase' THEN 'c' || event_id END AS commit_id,
  CAST(NULL AS VARCHAR) AS branch_name,
  json_extract_string(props, '$.k') AS k,
  CAST(user_id AS VARCHAR) AS user_id,
  4 AS n_vars
FROM events
""",
)
def f8_prefixed_vars(spark, sf_dir):
    ev = B.table(spark, sf_dir, "events")
    env = F.map_from_entries(
        F.filter(
            F.array(
                F.when(
                    F.col("event_type") == "purchase",
                    F.struct(F.lit(VAR_PREFIX + "COMMIT_ID").alias("k"), F.concat(F.lit("c"), F.col("event_id").cast("string")).alias("v")),
                ),
                F.struct(F.lit(VAR_PREFIX + "K").alias("k"), F.lit("sorts first, does not count").alias("v")),
                F.struct(F.lit(VAR_PREFIX + "k").alias("k"), F.get_json_object("props", "$.k").alias("v")),
                F.struct(F.lit("OTHER_VAR").alias("k"), F.col("event_type").alias("v")),
                F.struct(F.lit(VAR_PREFIX + "USER_" + VAR_PREFIX + "ID").alias("k"), F.col("user_id").cast("string").alias("v")),
            ),
            lambda e: e.isNotNull(),
        )
    )
    m = X.prefixed_vars(env)
    return ev.select(
        "event_id",
        F.try_element_at(m, F.lit("commit_id")).alias("commit_id"),
        F.try_element_at(m, F.lit("branch_name")).alias("branch_name"),
        F.try_element_at(m, F.lit("k")).alias("k"),
        F.try_element_at(m, F.lit("user_id")).alias("user_id"),
        F.size(m).alias("n_vars"),
    )


# --------------------------------------------------------------------------
# Per-worker settings, calendars, mounts.

_SUPPLIER_SETTINGS_SQL = """
WITH s AS (
  SELECT s_suppkey,
    CASE WHEN s_suppkey % 4 <> 0 THEN CAST(s_nationkey + 1 AS VARCHAR) || 'g' END AS limits_memory,
    CASE WHEN s_suppkey % 3 <> 0 THEN CAST(s_suppkey % 8 + 1 AS VARCHAR) ELSE '' END AS limits_cpu,
    CASE WHEN s_suppkey % 5 <> 0 THEN '1' END AS requests_cpu,
    CASE WHEN s_suppkey % 2 = 0 THEN 'standard' END AS storage_class,
    CASE WHEN s_suppkey % 3 = 0 THEN '10Gi' END AS storage_size,
    CASE WHEN s_nationkey % 4 = 0 THEN '' ELSE CAST(s_nationkey AS VARCHAR) END AS nation_label,
    CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE 'secret-' || s_suppkey END AS token
  FROM supplier),
w AS (SELECT unnest(['driver', 'executor']) AS w),
kv AS (
  SELECT s_suppkey, 'spark.' || w || '.memory' AS conf_key, limits_memory AS conf_value FROM s, w
  UNION ALL SELECT s_suppkey, 'spark.kubernetes.' || w || '.limit.cores', limits_cpu FROM s, w
  UNION ALL SELECT s_suppkey, 'spark.' || w || '.cores', requests_cpu FROM s, w
  UNION ALL SELECT s_suppkey, 'spark.kubernetes.' || w || '.volumes.persistentVolumeClaim.spark-local-dir-1' || suffix,
                   CASE suffix WHEN '.options.claimName' THEN 'OnDemand' WHEN '.options.storageClass' THEN storage_class
                               WHEN '.options.sizeLimit' THEN storage_size WHEN '.mount.path' THEN '/storage'
                               ELSE 'false' END
            FROM s, w, (SELECT unnest(['.options.claimName', '.options.storageClass', '.options.sizeLimit',
                                       '.mount.path', '.mount.readOnly']) AS suffix)
            WHERE storage_class IS NOT NULL AND storage_size IS NOT NULL)
"""


@register(
    "f10_fan_out_keys",
    _SUPPLIER_SETTINGS_SQL + """SELECT s_suppkey, conf_key, conf_value FROM kv WHERE conf_value IS NOT NULL AND conf_value <> ''
UNION ALL SELECT s_suppkey, 'spark.kubernetes.' || w || '.label.nation', nation_label FROM s, w
UNION ALL SELECT s_suppkey, 'spark.kubernetes.' || w || '.secrets.token', token FROM s, w""",
)
def f10_fan_out_keys(spark, sf_dir):
    s = B.table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    conf = s.select(
        "s_suppkey",
        F.when(k % 4 != 0, F.concat((F.col("s_nationkey") + 1).cast("string"), F.lit("g"))).alias("limits_memory"),
        F.when(k % 3 != 0, (k % 8 + 1).cast("string")).otherwise(F.lit("")).alias("limits_cpu"),
        F.when(k % 5 != 0, F.lit("1")).alias("requests_cpu"),
        F.when(k % 2 == 0, F.lit("standard")).alias("storage_class"),
        F.when(k % 3 == 0, F.lit("10Gi")).alias("storage_size"),
        F.create_map(
            F.lit("nation"), F.when(F.col("s_nationkey") % 4 == 0, F.lit("")).otherwise(F.col("s_nationkey").cast("string"))
        ).alias("labels"),
        F.create_map(
            F.lit("token"), F.when(k % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("secret-"), k.cast("string")))
        ).alias("secrets"),
    )
    return SC.fan_out_keys(
        conf, "s_suppkey", storage_class="storage_class", storage_size="storage_size", secrets="secrets", labels="labels"
    )


_AS_OF_F11 = "2001-09-01 00:00:00"


@register(
    "f11_run_calendar",
    f"""
WITH s AS (SELECT o_custkey AS pipeline_id, min(o_orderdate) AS start FROM orders GROUP BY 1),
p AS (SELECT pipeline_id, start, CASE pipeline_id % 3 WHEN 0 THEN '@monthly' WHEN 1 THEN '@weekly' END AS preset FROM s),
f AS (
  SELECT pipeline_id, preset,
    CASE preset
      WHEN '@monthly' THEN CASE WHEN date_trunc('month', start) < start THEN date_trunc('month', start) + INTERVAL 1 MONTH
                                ELSE date_trunc('month', start) END
      ELSE CASE WHEN date_trunc('day', start) - to_days(CAST(dayofweek(start) AS INTEGER)) < start
                THEN date_trunc('day', start) - to_days(CAST(dayofweek(start) AS INTEGER)) + INTERVAL 7 DAY
                ELSE date_trunc('day', start) - to_days(CAST(dayofweek(start) AS INTEGER)) END
    END AS first
  FROM p WHERE preset IS NOT NULL)
SELECT pipeline_id, preset, CAST(unnest(generate_series(first, TIMESTAMP '{_AS_OF_F11}' - INTERVAL 1 MONTH, INTERVAL 1 MONTH))
  AS TIMESTAMP) AS run_ts FROM f WHERE preset = '@monthly'
UNION ALL
SELECT pipeline_id, preset, CAST(unnest(generate_series(first, TIMESTAMP '{_AS_OF_F11}' - INTERVAL 7 DAY, INTERVAL 7 DAY))
  AS TIMESTAMP) FROM f WHERE preset = '@weekly'
""",
)
def f11_run_calendar(spark, sf_dir):
    """Monthly, weekly and unscheduled pipelines."""
    o = B.table(spark, sf_dir, "orders")
    starts = o.groupBy(F.col("o_custkey").alias("pipeline_id")).agg(F.min("o_orderdate").alias("start"))
    k = F.col("pipeline_id") % 3
    starts = starts.withColumn("preset", F.when(k == 0, F.lit("@monthly")).when(k == 1, F.lit("@weekly")))
    cal = D.run_calendar(starts, "start", F.col("preset"), F.lit(_AS_OF_F11))
    return cal.select("pipeline_id", "preset", F.col("run_ts").cast("timestamp_ntz").alias("run_ts"))


@register(
    "f12_explode_mounts",
    """
WITH c AS (SELECT conv_id, turn, role FROM conversations),
m AS (
  SELECT conv_id, turn, 0 AS pos, 'conv-' || conv_id AS secret, 'env' AS deploy_type, upper(role) AS deploy_target,
         CASE WHEN turn % 2 = 0 THEN 'k' || turn END AS key
  FROM c WHERE turn % 5 <> 4
  UNION ALL
  SELECT conv_id, turn, 1, role, 'volume', NULL, NULL FROM c WHERE turn % 5 <> 4 AND turn % 3 = 0
  UNION ALL
  SELECT conv_id, turn, 1, NULL, NULL, NULL, NULL FROM c WHERE turn % 5 <> 4 AND turn % 3 <> 0
  UNION ALL
  SELECT conv_id, turn, NULL, NULL, NULL, NULL, NULL FROM c WHERE turn % 5 = 4)
SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos, secret, deploy_type, deploy_target, key FROM m
""",
)
def f12_explode_mounts(spark, sf_dir):
    c = B.table(spark, sf_dir, "conversations")
    t = F.col("turn")
    first = F.map_from_entries(
        F.filter(
            F.array(
                F.struct(F.lit("secret").alias("k"), F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("v")),
                F.struct(F.lit("deploy_target").alias("k"), F.upper("role").alias("v")),
                F.when(t % 2 == 0, F.struct(F.lit("key").alias("k"), F.concat(F.lit("k"), t.cast("string")).alias("v"))),
            ),
            lambda e: e.isNotNull(),
        )
    )
    second = F.when(t % 3 == 0, F.create_map(F.lit("secret"), F.col("role"), F.lit("deploy_type"), F.lit("volume")))
    mounts = F.when(t % 5 == 4, F.array().cast("array<map<string,string>>")).otherwise(F.array(first, second))
    rows = c.select(F.struct("conv_id", "turn").alias("id"), mounts.alias("mounts"))
    return SC.explode_mounts(rows, "id", "mounts").select("id.conv_id", "id.turn", "pos", *SC.MOUNT_FIELDS)


@register(
    "f12_explode_tolerations",
    """
SELECT p_partkey, 0 AS pos, 'NoSchedule' AS effect, p_brand AS key, CASE WHEN p_size % 2 = 0 THEN 'Equal' END AS operator,
       CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS VARCHAR) END AS value FROM part WHERE p_size % 5 <> 0
UNION ALL
SELECT p_partkey, NULL, NULL, NULL, NULL, NULL FROM part WHERE p_size % 5 = 0
""",
)
def f12_explode_tolerations(spark, sf_dir):
    p = B.table(spark, sf_dir, "part")
    always = F.create_map(F.lit("effect"), F.lit("NoSchedule"), F.lit("key"), F.col("p_brand"))
    more = F.create_map(F.lit("operator"), F.lit("Equal"), F.lit("value"), F.col("p_size").cast("string"))
    one = F.when(F.col("p_size") % 2 == 0, F.map_concat(always, more)).otherwise(always)
    rows = p.select("p_partkey", F.when(F.col("p_size") % 5 != 0, F.array(one)).alias("tolerations"))
    return SC.explode_tolerations(rows, "p_partkey", "tolerations")


# --------------------------------------------------------------------------
# Profiles and overlays.

def _profiles(spark, sf_dir):
    """Profiles: every part brand but the two that sort last, plus the default."""
    brands = B.table(spark, sf_dir, "part").select(F.col("p_brand").alias("profile")).distinct()
    last = brands.agg(F.max("profile")).first()[0]
    second = brands.filter(F.col("profile") < F.lit(last)).agg(F.max("profile")).first()[0]
    kept = brands.filter(F.col("profile") < F.lit(second))
    num = F.substring_index("profile", "#", -1)
    named = kept.select(
        "profile",
        F.struct(num.alias("cpu"), F.concat(num, F.lit("Gi")).alias("memory")).alias("requests"),
        F.struct(F.concat(num, F.lit("000m")).alias("cpu"), F.lit(None).cast("string").alias("memory")).alias("limits"),
        F.create_map(F.lit("brand"), F.col("profile")).alias("labels"),
    )
    default = spark.range(1).select(
        F.lit("__default__").alias("profile"),
        F.struct(F.lit("1").alias("cpu"), F.lit("1Gi").alias("memory")).alias("requests"),
        F.struct(F.lit("2").alias("cpu"), F.lit("2Gi").alias("memory")).alias("limits"),
        F.create_map().cast("map<string,string>").alias("labels"),
    )
    return named.unionByName(default)


@register(
    "j2_assign_profile",
    """
WITH b AS (SELECT DISTINCT p_brand FROM part),
kept AS (SELECT p_brand FROM b QUALIFY row_number() OVER (ORDER BY p_brand DESC) > 2),
n AS (SELECT 'p' || p_partkey AS node, CASE WHEN p_size <> 1 THEN p_brand ELSE '__default__' END AS profile_key
      FROM part
      UNION ALL SELECT 'o' || o_orderkey, '__default__' FROM orders
      UNION ALL SELECT 'c' || c_custkey, '__default__' FROM customer
      UNION ALL SELECT 'n' || n_nationkey, '__default__' FROM nation)
SELECT 'layered' AS pipeline, n.node, n.profile_key,
  CASE WHEN n.profile_key = '__default__' THEN '__default__' WHEN k.p_brand IS NOT NULL THEN k.p_brand END AS profile,
  CASE WHEN n.profile_key = '__default__' THEN '1' WHEN k.p_brand IS NOT NULL THEN split_part(k.p_brand, '#', 2) END
    AS requests_cpu,
  CASE WHEN n.profile_key = '__default__' THEN '1Gi' WHEN k.p_brand IS NOT NULL THEN split_part(k.p_brand, '#', 2) || 'Gi' END
    AS requests_memory,
  CASE WHEN n.profile_key = '__default__' THEN '2' WHEN k.p_brand IS NOT NULL THEN split_part(k.p_brand, '#', 2) || '000m' END
    AS limits_cpu,
  CASE WHEN n.profile_key = '__default__' THEN '2Gi' END AS limits_memory,
  CAST(CASE WHEN k.p_brand IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS n_labels
FROM n LEFT JOIN kept k ON k.p_brand = n.profile_key
""",
)
def j2_assign_profile(spark, sf_dir):
    nodes, _, _ = B.layered_dag(spark, sf_dir)
    out = lookup.assign_profile(nodes, _profiles(spark, sf_dir))
    return out.select(
        "pipeline",
        "node",
        "profile_key",
        "profile",
        F.col("requests.cpu").alias("requests_cpu"),
        F.col("requests.memory").alias("requests_memory"),
        F.col("limits.cpu").alias("limits_cpu"),
        F.col("limits.memory").alias("limits_memory"),
        F.coalesce(F.size("labels"), F.lit(0)).alias("n_labels"),
    )


def _layers(spark, sf_dir):
    """Layer 0 from the nation, 1 from the market segment, 2 the customer's
    own values; same keys.  The customer layer sets ``tier`` to null on
    every fourth customer (a present null wins) and omits ``owner`` on
    three of four."""
    c = B.table(spark, sf_dir, "customer")
    n = B.table(spark, sf_dir, "nation")
    cn = c.join(n, c.c_nationkey == n.n_nationkey)

    def layer(df, level, entries):
        return df.select(
            F.col("c_custkey").alias("entity"),
            F.lit(level).alias("layer"),
            F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e"),
        ).select("entity", "layer", F.col("e.key").alias("key"), F.col("e.value").alias("value"))

    kv = lambda k, v: F.struct(F.lit(k).alias("key"), v.cast("string").alias("value"))
    k = F.col("c_custkey") % 4
    return (
        layer(cn, 0, [kv("label", F.col("n_name")), kv("owner", F.concat(F.lit("nation-"), F.col("n_nationkey").cast("string"))), kv("tier", F.lit("bronze"))])
        .unionByName(layer(cn, 1, [kv("label", F.col("c_mktsegment")), kv("tier", F.when(F.col("c_mktsegment") == "BUILDING", "silver").otherwise("steel"))]))
        .unionByName(
            layer(
                cn,
                2,
                [
                    kv("label", F.col("c_name")),
                    F.when(k == 1, kv("owner", F.concat(F.lit("cust-"), F.col("c_custkey").cast("string")))),
                    F.when(k == 0, kv("tier", F.lit(None))),
                ],
            )
        )
    )


@register(
    "w5_overlay",
    """
WITH c AS (SELECT c_custkey, c_name, c_mktsegment, n_name, n_nationkey FROM customer JOIN nation ON c_nationkey = n_nationkey),
l AS (
  SELECT c_custkey AS entity, 0 AS layer, 'label' AS key, n_name AS value FROM c
  UNION ALL SELECT c_custkey, 0, 'owner', 'nation-' || n_nationkey FROM c
  UNION ALL SELECT c_custkey, 0, 'tier', 'bronze' FROM c
  UNION ALL SELECT c_custkey, 1, 'label', c_mktsegment FROM c
  UNION ALL SELECT c_custkey, 1, 'tier', CASE WHEN c_mktsegment = 'BUILDING' THEN 'silver' ELSE 'steel' END FROM c
  UNION ALL SELECT c_custkey, 2, 'label', c_name FROM c
  UNION ALL SELECT c_custkey, 2, 'owner', 'cust-' || c_custkey FROM c WHERE c_custkey % 4 = 1
  UNION ALL SELECT c_custkey, 2, 'tier', NULL FROM c WHERE c_custkey % 4 = 0)
SELECT entity, key, value, layer FROM l
QUALIFY row_number() OVER (PARTITION BY entity, key ORDER BY layer DESC) = 1
""",
)
def w5_overlay(spark, sf_dir):
    return lookup.overlay(_layers(spark, sf_dir))
