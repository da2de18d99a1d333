"""Batch and run lifecycle over append-only logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Outcomes of a claim, and the texts of retry and failure records.
CLAIM_NEW, CLAIM_RETRY = "CLAIM_NEW", "CLAIM_RETRY"
REJECT_RUNNING, REJECT_SUCCESS, REJECT_OTHER = "REJECT_RUNNING", "REJECT_SUCCESS", "REJECT_OTHER_PIPELINE"
RETRY_WITHOUT_ERROR = "Task retry requested without an exception."
RECOVERED_MESSAGE = "Task succeeded after one or more retries."
FAILED_WITHOUT_ERROR = "Task failed without an exception."
UNKNOWN_ERROR = "UnknownError"
DEFAULT_FAILURE_STAGE = "unknown"
DEFAULT_FAILURE_TYPE = "PipelineFailure"
DEFAULT_FAILURE_MESSAGE = "Airflow customer pipeline failed. See task logs for details."
FAILURE_STAGE_ORDER = ("prepare_run", "bronze", "silver")


class BatchRejectedError(ValueError):
    """The batch cannot be claimed by this attempt."""


def latest_state(log: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """Current row per id: the log row with the highest sequence number (a combinable aggregate)."""
    rest = [c for c in log.columns if c not in (key, seq)]
    return (
        log.groupBy(key)
        .agg(F.max_by(F.struct(*rest), seq).alias("_row"))
        .select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])
    )


CLAIM, COMPLETE = "CLAIM", "COMPLETE"
STRIDE = 100_000  # requests of one batch that are ordered in one task


def batch_transition(requests: DataFrame, batch_log: DataFrame, stride: int = STRIDE) -> DataFrame:
    """What happens to each claim, given the batches' current state and the requests before it.

    Requests hold ``batch_id`` and ``pipeline_name``, and for a stream of them also ``seq``, their order, ``kind``, CLAIM or
    COMPLETE, and the ``status`` of a completion.  The state machine of a batch: its first claim makes it the claimant's
    and RUNNING, a completion sets its status, the owner's claim makes a FAILED batch RUNNING again, and nothing leaves
    SUCCESS but a completion.  Completions before the first claim have no batch to close.  Claims at one seq are taken in
    the order of their pipeline's name.

    So a batch's status before a request follows from the newest completion before it and whether its owner has claimed
    since: two running maxima, which are taken within strides of ``stride`` numbers and then over a batch's strides.  No
    task orders more than a stride of one batch, however many requests it gets.  Requests without a ``seq`` are claims at
    one moment and need no strides.
    """
    if "seq" not in requests.columns:
        return _claimed_at_once(requests, batch_log)
    streamed = {"seq": "CAST(0 AS BIGINT)", "kind": f"'{CLAIM}'", "status": "CAST(NULL AS STRING)"}
    asked = requests.selectExpr("*", *[f"{sql} AS {name}" for name, sql in streamed.items() if name not in requests.columns])
    state = latest_state(batch_log, "batch_id").select(
        "batch_id", F.col("pipeline_name").alias("logged_owner"), F.col("status").alias("logged")
    )
    claims = F.when(F.col("kind") == CLAIM, F.struct("seq", F.col("pipeline_name").alias("name")))
    first = asked.groupBy(F.col("batch_id").alias("_first_batch")).agg(F.min(claims).alias("_first"))
    known = (
        asked.join(first, F.col("batch_id") == F.col("_first_batch"))
        .join(state, "batch_id", "left")
        .withColumn("owner", F.coalesce("logged_owner", "_first.name"))
        .withColumn("stride", F.floor(F.col("seq") / stride))
        .drop("_first_batch")
    )
    exists = F.col("logged").isNotNull() | (F.col("_first.seq") < F.col("seq"))
    # Places in the order: of equal numbers completions come first, then claims by pipeline.
    place = F.struct("seq", F.when(F.col("kind") == CLAIM, 1).otherwise(0).alias("late"), F.coalesce("pipeline_name", F.lit("")).alias("name"))
    closed = F.when((F.col("kind") == COMPLETE) & exists, F.struct(place.alias("at"), "status"))
    owned = F.when((F.col("kind") == CLAIM) & (F.col("pipeline_name") == F.col("owner")), place)
    marked = known.withColumns({"place": place, "closed": closed, "owned": owned})
    before = Window.partitionBy("batch_id", "stride").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    inside = marked.withColumns({x: F.max(x).over(before) for x in ("closed", "owned")})
    sums = marked.groupBy(F.col("batch_id").alias("_batch"), F.col("stride").alias("_stride")).agg(
        F.max("closed").alias("_closed"), F.max("owned").alias("_owned")
    )
    earlier = Window.partitionBy("_batch").orderBy("_stride").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns({x: F.max(x).over(earlier) for x in ("_closed", "_owned")})
    folded = inside.join(sums, (F.col("batch_id") == F.col("_batch")) & (F.col("stride") == F.col("_stride")))
    folded = folded.withColumns({"closed": F.coalesce("closed", "_closed"), "owned": F.coalesce("owned", "_owned")})
    return _judged(folded.withColumn("current_status", _status_before()).filter(F.col("kind") == CLAIM), True)


def _claimed_at_once(requests: DataFrame, batch_log: DataFrame) -> DataFrame:
    state = latest_state(batch_log, "batch_id").select(
        "batch_id", F.col("pipeline_name").alias("logged_owner"), F.col("status").alias("logged")
    )
    ordered = Window.partitionBy("batch_id").orderBy("pipeline_name")
    earlier = F.max(F.col("pipeline_name") == F.col("owner")).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    claims = requests.join(state, "batch_id", "left").withColumn("owner", F.coalesce("logged_owner", F.first("pipeline_name").over(ordered)))
    taken = F.coalesce(earlier, F.lit(False)) & ~F.coalesce(F.col("logged") == "SUCCESS", F.lit(False))
    return _judged(claims.withColumn("current_status", F.when(taken, "RUNNING").otherwise(F.col("logged"))), False)


def _status_before() -> Column:
    set_to = F.coalesce("closed.status", "logged")
    claimed = F.col("owned").isNotNull() & (F.col("closed").isNull() | (F.col("owned") > F.col("closed.at")))
    return F.when(claimed & ~F.coalesce(set_to == "SUCCESS", F.lit(False)), "RUNNING").otherwise(set_to)


def _judged(claims: DataFrame, in_order: bool) -> DataFrame:
    """Outcome and message of claims whose batch is the ``owner``'s, if it has a ``current_status``."""
    outcome = (
        F.when(F.col("current_status").isNull(), CLAIM_NEW)
        .when(F.col("owner") != F.col("pipeline_name"), REJECT_OTHER)
        .when(F.col("current_status") == "FAILED", CLAIM_RETRY)
        .when(F.col("current_status") == "SUCCESS", REJECT_SUCCESS)
        .otherwise(REJECT_RUNNING)
    )
    batch = F.concat(F.lit("Batch "), F.col("batch_id"))
    message = (
        F.when(
            F.col("outcome") == REJECT_OTHER,
            F.concat(
                batch, F.lit(" belongs to pipeline '"), F.col("owner"), F.lit("', not '"), F.col("pipeline_name"), F.lit("'.")
            ),
        )
        .when(F.col("outcome") == REJECT_SUCCESS, F.concat(batch, F.lit(" has already completed successfully.")))
        .when(F.col("outcome") == REJECT_RUNNING, F.concat(batch, F.lit(" is already running.")))
    )
    new_status = F.when(F.col("outcome").isin(CLAIM_NEW, CLAIM_RETRY), "RUNNING").otherwise(F.col("current_status"))
    return (
        claims.withColumn("outcome", outcome)
        .withColumns({"message": message, "new_status": new_status})
        .select("batch_id", "pipeline_name", *["seq"] * in_order, "current_status", "outcome", "new_status", "message")
    )


def completion_rows(batch_log: DataFrame, results: DataFrame) -> DataFrame:
    """Log rows that close batches: ``results`` holds batch_id, completed_at, status, rows_processed, error_message."""
    running = batch_log.groupBy("batch_id").agg(
        F.max_by(F.struct("pipeline_name", "started_at"), "seq").alias("_s"), F.max("seq").alias("seq")
    )
    return running.join(results, "batch_id").select(
        "batch_id",
        F.col("_s.pipeline_name").alias("pipeline_name"),
        F.col("_s.started_at").alias("started_at"),
        "completed_at",
        "status",
        "rows_processed",
        "error_message",
        (F.col("seq") + 1).alias("seq"),
    )


def successful_batches(batch_log: DataFrame) -> DataFrame:
    return latest_state(batch_log, "batch_id").filter("status = 'SUCCESS'")


def newest_runs(runs: DataFrame, n: int) -> DataFrame:
    """The ``n`` newest runs: a top-n per partition and a final merge, no global sort."""
    return runs.orderBy(F.desc("started_at"), F.desc("pipeline_run_id")).limit(n)


def batch_rows_processed(stage_results: DataFrame) -> DataFrame:
    """Rows newly landed per run: the sum over its ``*_bronze`` stages."""
    return (
        stage_results.filter(F.col("stage_name").endswith("_bronze"))
        .groupBy("pipeline_run_id")
        .agg(F.sum("rows_processed").alias("rows_processed"))
    )


def retry_events(attempts: DataFrame) -> DataFrame:
    """RETRY for each attempt that will be tried again, RECOVERED for a success after the first try."""
    retrying = F.col("state") == "up_for_retry"
    recovered = (F.col("state") == "success") & (F.col("try_number") > 1)
    event = F.when(retrying, "RETRY").when(recovered, "RECOVERED")
    return (
        attempts.filter((retrying | recovered) & F.col("pipeline_run_id").isNotNull())
        .select(
            "pipeline_run_id",
            "batch_id",
            "pipeline_name",
            "stage_name",
            event.alias("event_type"),
            F.col("ended_at").alias("event_time"),
            "dag_run_id",
            "try_number",
            F.when(retrying, F.coalesce("error_type", F.lit(UNKNOWN_ERROR))).alias("error_type"),
            F.when(retrying, F.coalesce("error_message", F.lit(RETRY_WITHOUT_ERROR)))
            .otherwise(F.lit(RECOVERED_MESSAGE))
            .alias("event_message"),
        )
    )


def stage_attempts(runs: DataFrame, stages: DataFrame) -> DataFrame:
    """Attempts, as ``retry_events`` and ``failure_summary`` read them, from the logs of runs and stages.

    ``runs`` and ``stages`` are current rows, one for each id.  Executions of a stage are lined up over all runs of a
    batch.  A failed one is up for retry when the stage is executed again, and its number counts the tries since the
    stage last succeeded: a lag over the sequence, with no row but the batch's own in a group.
    """
    own = runs.select("pipeline_run_id", "batch_id", "pipeline_name")
    lined = Window.partitionBy("batch_id", "stage_name").orderBy("started_at", "stage_run_id")
    before = lined.rowsBetween(Window.unboundedPreceding, -1)
    streak = F.coalesce(F.sum(F.when(F.col("status") == "SUCCESS", 1).otherwise(0)).over(before), F.lit(0))
    tries = Window.partitionBy("batch_id", "stage_name", "_streak").orderBy("started_at", "stage_run_id")
    state = (
        F.when(F.col("status") == "SUCCESS", "success")
        .when(F.col("status") != "FAILED", "running")
        .when(F.col("_again"), "up_for_retry")
        .otherwise("failed")
    )
    return (
        stages.join(own, "pipeline_run_id")
        .withColumns({"_streak": streak, "_again": F.lead("stage_run_id").over(lined).isNotNull()})
        .withColumns({"state": state, "try_number": F.row_number().over(tries)})
        .select(
            "pipeline_run_id", "batch_id", "pipeline_name", "stage_name", F.lit(None).cast("string").alias("dag_run_id"),
            "try_number", "state", "error_type", "error_message", F.col("completed_at").alias("ended_at"),
        )
    )


def failure_summary(
    failed_runs: DataFrame, attempts: DataFrame, order: tuple[str, ...] = FAILURE_STAGE_ORDER, states: tuple[str, ...] = ("failed",)
) -> DataFrame:
    """Per failed run the first failing stage (by default prepare, bronze, silver) with its latest failure, or defaults.

    ``attempts`` needs pipeline_run_id, stage_name, state, try_number, error_type and error_message; those in ``states``
    are failures.  A stage that ``order`` does not name comes before those it names.
    """
    position = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("stage_name"))
    detail = F.struct(
        "stage_name",
        F.coalesce("error_type", F.lit(UNKNOWN_ERROR)).alias("error_type"),
        F.coalesce("error_message", F.lit(FAILED_WITHOUT_ERROR)).alias("error_message"),
        "try_number",
    )
    # A later failure of the same stage replaces the earlier one; equal times fall back to try and texts.
    rank = F.struct(-position, "ended_at", "try_number", "error_type", "error_message")
    first = (
        attempts.filter(F.col("state").isin(*states)).groupBy("pipeline_run_id").agg(F.max_by(detail, rank).alias("_d"))
    )
    return failed_runs.select("pipeline_run_id").join(first, "pipeline_run_id", "left").select(
        "pipeline_run_id",
        F.coalesce("_d.stage_name", F.lit(DEFAULT_FAILURE_STAGE)).alias("stage_name"),
        F.coalesce("_d.error_type", F.lit(DEFAULT_FAILURE_TYPE)).alias("error_type"),
        F.coalesce("_d.error_message", F.lit(DEFAULT_FAILURE_MESSAGE)).alias("error_message"),
        F.col("_d.try_number").alias("try_number"),
    )
