"""Fixed values that must equal the behaviour being rebuilt.

These are plain facts of the pipeline model (tag names, dataset class names,
defaults of settings), stated once here and used throughout.
"""

# Dataset classes whose datasets make a node a Spark node.
SPARK_DATASET_TYPES = ("SparkDataSet", "SparkHiveDataSet", "SparkJDBCDataSet")

# Default tag that forces a node into a Spark group; callers with another tag pass theirs.
SPARK_GROUP_TAG = "group:pyspark"

# Fixed value: fully qualified class of a Spark DataFrame type hint.
SPARK_FRAME_CLASS = "pyspark.sql.dataframe.DataFrame"

# Fixed value: prefix of the tag that names a node's profile.
RESOURCES_PREFIX = "resources:"

# Group types and group-name prefix.
GROUP_SPARK = "pyspark"
GROUP_DEFAULT = "default"
SPARK_GROUP_NAME_PREFIX = "pyspark_"

# Fixed value: profile used by nodes without a resources tag.
DEFAULT_PROFILE = "__default__"

# Failure handler types that are supported; others are dropped.
SUPPORTED_HANDLER_TYPES = ("slack",)
DEFAULT_FAILURE_MESSAGE = "Task failed!"

# Default prefix of the environment variables that fill placeholders; callers with another prefix pass theirs.
VAR_PREFIX = "PIPELINE_VAR_"
# Placeholder variables and their values when unset.
VAR_DEFAULTS = {"commit_id": None, "branch_name": None}

# Run-parameter keys logged when a tracked run starts.
RUN_PARAM_KEYS = ("image", "dag_id", "execution_date")

# Worker types that receive Spark settings.
WORKER_TYPES = ("driver", "executor")

# Terminal task states (a task in one of these will not change).
TERMINAL_STATES = ("success", "failed", "skipped", "upstream_failed")

# Schedule presets and their step.
SCHEDULE_PRESETS = {
    "@hourly": "1 hour",
    "@daily": "1 day",
    "@weekly": "1 week",
    "@monthly": "1 month",
}
