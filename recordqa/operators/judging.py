"""The judge stage around a user-supplied function: requests, answers, envelopes.

A judge is any callable ``pandas.DataFrame -> pandas.DataFrame`` that reads
``call_id, check_name, model_spec, request`` and returns ``call_id, response,
latency_ms``, or a factory of such a callable (built once per task, so a client
is opened once). Retries and throttling belong to it; no client is shipped.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from recordqa.functions.variants import encode_json, is_object, let, number_at, object_at, printed, string_at
from recordqa.operators.batching import line_positions, ranged_positions
from recordqa.operators.cost import cost_column, with_routing
from recordqa.operators.duplicates import dedupe_context
from recordqa.operators.records import check_input_struct, eligible, extract_payload
from recordqa.schema import CHECKS, PAYLOAD_FIELDS, PROVIDERS
from recordqa.session import bounded_batches, pin, stage_table
from recordqa.sources.lines import LINE_ORDER

# What precedes the input of a request: only the shape of the answer; wording is the caller's.
INSTRUCTION = 'JSON: {"results":[{"event_id":"string","result":{}}]}'
MAX_TOKENS = 1200  # fixed value
#: What a frame of requests that a judge is given may hold.
FRAME_BYTES = 4 << 20
DEFAULT_REASON = "No valid model result returned for this row."  # fixed value


# ---- requests -------------------------------------------------------------
def record_batches(
    records: DataFrame,
    size: int,
    order: tuple[str, ...] = LINE_ORDER,
    from_scan: bool = False,
    with_duplicates: bool = False,
    duplicate_threshold: float = 1.0,
) -> DataFrame:
    """Eligible records grouped into batches: ``batch_id, members``; staged.

    See ``grouped_records``. The raw text of a record is not among its members.
    """
    grouped, _ = grouped_records(records, size, order, from_scan, with_duplicates, duplicate_threshold)
    return stage_table(grouped, "batches")


def grouped_records(
    records: DataFrame,
    size: int,
    order: tuple[str, ...] = LINE_ORDER,
    from_scan: bool = False,
    with_duplicates: bool = False,
    duplicate_threshold: float = 1.0,
) -> tuple[DataFrame, DataFrame]:
    """Eligible records in batches (``batch_id, members``), and their raw text (``row_id, source_record``).

    All checks share the same eligible rows in the same order, so records are
    parsed, numbered and grouped once and fanned out to checks afterwards. The raw text is in no request, so it stays
    where it was staged and is looked up by row id where it is asked for.
    ``from_scan`` says that ``records`` are parsed lines of a scan, untouched
    since; numbering then needs no shuffle. ``with_duplicates`` counts the copies of each story over all
    records for the source check, and with a ``duplicate_threshold`` below 1 also the near copies; records then
    move, and are numbered by their order.
    """
    if size <= 0:
        raise ValueError("batch size must be positive")
    payload = extract_payload(records, (*order, F.col("value").alias("source_record")))
    flat = eligible(pin(payload)).withColumnRenamed("_pin", "row_id")
    if from_scan and not with_duplicates:
        staged = line_positions(flat)
        numbered = staged.drop("source_record").withColumn("_range", F.lit(0))
    else:
        staged = stage_table(flat, "payload")
        rows = staged.drop("source_record")
        if with_duplicates:
            rows = dedupe_context(rows, threshold=duplicate_threshold)
        numbered = ranged_positions(rows, order, size=size, keys_of=staged)
    member = F.struct("pos", "row_id", *PAYLOAD_FIELDS, *(["dedupe_context"] if with_duplicates else []))
    # a batch lies in one range, and the rows of a range are in one task already
    batch = F.floor(F.col("pos") / F.lit(size)).cast("bigint").alias("batch_id")
    batches = numbered.groupBy("_range", batch).agg(F.array_sort(F.collect_list(member)).alias("members")).drop("_range")
    return batches, staged.select("row_id", "source_record")


def _object(by_name: bool, **fields: Column) -> Column:
    return F.struct(*[fields[n].alias(n) for n in (sorted(fields) if by_name else fields)])


def _turn(role: str, content: Column, by_name: bool = False) -> Column:
    return _object(by_name, role=F.lit(role), content=content)


def _user_turn(instruction: str, payload_json: Column, by_name: bool = False) -> Column:
    return _turn("user", F.concat(F.lit(f"{instruction}\n\nINPUT:\n"), payload_json), by_name)


def chat_request(
    prompt: Column, model: Column, payload_json: Column, instruction: str = INSTRUCTION, by_name: bool = False
) -> Column:
    """Request body in chat form, as JSON text; with ``by_name`` its keys are in the order in which VARIANT prints them."""
    return encode_json(
        _object(
            by_name,
            model=model,
            temperature=F.lit(0),
            response_format=F.struct(F.lit("json_object").alias("type")),
            messages=F.array(_turn("system", prompt, by_name), _user_turn(instruction, payload_json, by_name)),
        )
    )


def block_request(
    prompt: Column, model: Column, payload_json: Column, instruction: str = INSTRUCTION, max_tokens: int = MAX_TOKENS, by_name: bool = False
) -> Column:
    """Request body of providers that answer in blocks: the system text stands beside the turns."""
    return encode_json(
        _object(
            by_name,
            model=model,
            max_tokens=F.lit(max_tokens),
            temperature=F.lit(0),
            system=prompt,
            messages=F.array(_user_turn(instruction, payload_json, by_name)),
        )
    )


_LAST_TURN = '{"role":"user","content":'


def printed_request(request: Column) -> Column:
    """As ``printed``, for the bodies built here: their last part is the user's turn, whose long text is not parsed."""
    head = F.substring_index(request, _LAST_TURN, 1)
    ours = request.endswith('"}]}') & (F.octet_length(head) < F.octet_length(request))
    start = F.octet_length(head) + len(_LAST_TURN) + 1
    # cut by bytes, for which the text is not walked through
    content = F.substr(request.cast("binary"), start, F.octet_length(request) - start - 2).cast("string")
    # a turn of nobody stands in for the last one; a text holds no quotes that are not escaped
    stand_in = '{"content":"","role":""}'
    shell = printed(F.concat(head, F.lit('{"role":"","content":""}]}')))
    whole = F.concat(
        F.substring_index(shell, stand_in, 1), F.lit('{"content":'), content, F.lit(',"role":"user"}'), F.substring_index(shell, stand_in, -1)
    )
    return F.when(ours, whole).otherwise(printed(request))


def provider_request(
    provider: Column, prompt: Column, model: Column, payload_json: Column, instruction: str = INSTRUCTION, by_name: bool = False
) -> Column:
    """The body in the provider's own shape."""
    return F.when(provider == "openai", chat_request(prompt, model, payload_json, instruction, by_name)).otherwise(
        block_request(prompt, model, payload_json, instruction, by_name=by_name)
    )


def build_requests(
    batches: DataFrame,
    prompts: DataFrame,
    routing: dict[str, str],
    run_id: str,
    max_body_chars: int = 0,
    instruction: str = INSTRUCTION,
    by_name: bool = False,
) -> DataFrame:
    """One request row per (check, batch): ``call_id``, envelope columns, ``request`` (``by_name``: see ``chat_request``).

    Only the narrow request leaves this step; bodies are truncated inside it. Further columns of a batch go with its requests.
    """
    more = [c for c in batches.columns if c not in ("batch_id", "members", "n_rows")]
    filled = "dedupe_context" in batches.schema["members"].dataType.elementType.fieldNames()

    def inputs_of(check: str) -> Column:
        context = lambda m: m["dedupe_context"] if filled else None
        return encode_json(
            F.transform("members", lambda m: check_input_struct(lambda f: m[f], check, max_body_chars, context(m)))
        )

    # inputs are built after the fan-out, so readers of the other columns do not build them
    inputs = F.when(F.col("check_name") == CHECKS[0], inputs_of(CHECKS[0]))
    for c in CHECKS[1:]:
        inputs = inputs.when(F.col("check_name") == c, inputs_of(c))
    sized = batches if "n_rows" in batches.columns else batches.withColumn("n_rows", F.size("members").cast("bigint"))
    fanned = sized.withColumn(
        "check_name", F.explode(F.array(*[F.lit(c) for c in CHECKS]))
    )
    fanned = fanned.select("batch_id", "n_rows", *more, "check_name", inputs.alias("inputs"))
    # One latest prompt per base, and only the bases of the closed check list: a handful of rows.
    meta = prompts.filter(F.col("base").isin(*CHECKS)).select(
        F.col("base").alias("check_name"),
        F.col("version").alias("prompt_version"),
        F.col("file").alias("prompt_file"),
        F.col("text").alias("prompt"),
    )
    routed = with_routing(fanned, routing).join(F.broadcast(meta), "check_name")
    return routed.select(
        F.concat_ws("/", F.lit(run_id), "check_name", F.col("batch_id").cast("string")).alias("call_id"),
        F.lit(run_id).alias("run_id"),
        "check_name",
        "batch_id",
        "n_rows",
        "prompt_version",
        "prompt_file",
        "model_spec",
        "provider",
        "model",
        provider_request(F.col("provider"), F.col("prompt"), F.col("model"), F.col("inputs"), instruction, by_name).alias("request"),
        *more,
    )


# ---- judge ----------------------------------------------------------------
Judge = Callable[[pd.DataFrame], pd.DataFrame]


def judge(
    requests: DataFrame, fn: Judge | None = None, factory: Callable[[], Judge] | None = None, only_answers: bool = False
) -> DataFrame:
    """Apply a judge to request rows: the rows plus ``response`` and ``latency_ms``, or these beside ``call_id`` alone.

    The request columns pass through the same batch, so answers need no join back.
    A judge that leaves a call unanswered fails the task. Not deterministic and not
    free: stage the result before reading it twice. Requests reach the judge in frames bounded by bytes, so what
    Python holds does not depend on how many requests a task has.
    """
    if (fn is None) == (factory is None):
        raise ValueError("give either fn or factory")
    bounded_batches(requests.sparkSession, FRAME_BYTES)
    if only_answers:
        requests = requests.select("call_id", "check_name", "model_spec", "request")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = fn if factory is None else factory()
        for pdf in batches:
            answers = call(pdf[["call_id", "check_name", "model_spec", "request"]])
            answers = answers[["call_id", "response", "latency_ms"]]
            if sorted(answers["call_id"]) != sorted(pdf["call_id"]):
                raise ValueError("the judge must answer every call exactly once")
            yield answers if only_answers else pdf.merge(answers, on="call_id")

    added = [T.StructField("response", T.StringType()), T.StructField("latency_ms", T.DoubleType())]
    kept = [requests.schema["call_id"]] if only_answers else requests.schema.fields
    return requests.mapInPandas(run, T.StructType([*kept, *added]))


def one_response(responses: DataFrame) -> DataFrame:
    """``call_id, response, latency_ms``: one row per call, however often it was stored.

    The last by ``stored_at`` if there is such a column; then a response beats none, and equal times are decided by
    latency and text, so the choice does not depend on the layout.
    """
    order = [F.col(c) for c in ("stored_at",) if c in responses.columns]
    last = F.max_by(
        F.struct("response", "latency_ms"), F.struct(*order, F.col("response").isNotNull().alias("given"), "latency_ms", "response")
    )
    return responses.groupBy("call_id").agg(last.alias("_r")).select("call_id", "_r.*")


class ResponseStore:
    """Responses of a run in committed waves, below one folder all executors reach.

    A wave is written to a folder of its own and then named in the log; readers see the waves in the log
    only. A job that is lost in a wave has therefore paid for that wave alone: the next one asks for
    what no committed wave holds.
    """

    FIELDS = "call_id string, response string, latency_ms double, stored_at timestamp"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def committed(self) -> DataFrame:
        """Responses of all committed waves: ``call_id, response, latency_ms, stored_at``."""
        try:
            log = self.spark.read.schema("wave string").parquet(f"{self.folder}/log")
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.FIELDS)
        # one name per commit; the join prunes the folders of other waves
        stored = self.spark.read.schema(f"{self.FIELDS}, wave string").parquet(f"{self.folder}/waves")
        return stored.join(log, "wave", "left_semi").drop("wave")

    def commit(self, judged: DataFrame) -> None:
        name = uuid.uuid4().hex
        rows = judged.select("call_id", "response", F.col("latency_ms").cast("double"), F.current_timestamp().alias("stored_at"))
        rows.write.mode("errorifexists").parquet(f"{self.folder}/waves/wave={name}")
        self.spark.createDataFrame([(name,)], "wave string").coalesce(1).write.mode("append").parquet(f"{self.folder}/log")


def with_given(batches: DataFrame, responses: DataFrame, run_id: str) -> DataFrame:
    """Batches plus ``_given``: the responses (one per call) of their calls by check name.

    Responses meet their batch before its requests are built, so requests never travel.
    """
    check, batch = F.split_part("call_id", F.lit("/"), F.lit(-2)), F.split_part("call_id", F.lit("/"), F.lit(-1)).try_cast("bigint")
    own = responses.select("call_id", check.alias("_check"), batch.alias("batch_id"), F.struct("response", F.col("latency_ms").cast("double").alias("latency_ms")).alias("_r"))
    own = own.filter(F.col("_check").isin(*CHECKS) & (F.col("call_id") == F.concat_ws("/", F.lit(run_id), "_check", F.col("batch_id").cast("string"))))
    given = own.groupBy("batch_id").agg(F.map_from_entries(F.collect_list(F.struct("_check", "_r"))).alias("_given"))
    return batches.join(given, "batch_id", "left")


def wave_of(waves: int) -> Column:
    if waves <= 0:
        raise ValueError("waves must be positive")
    return F.pmod(F.col("batch_id"), F.lit(waves)).cast("int")


def judge_in_waves(
    requests: DataFrame, store: ResponseStore, waves: int, fn: Judge | None = None, factory: Callable[[], Judge] | None = None
) -> None:
    """Asks ``requests``, which the store does not hold, in up to ``waves`` commits; they are read once per wave.

    Calls are dealt to waves by batch number (``wave_of``), so a wave holds every check of its batches; where requests have
    it in ``_wave``, as batches staged by it do, a wave reads no other.
    """
    own = F.col("_wave") if "_wave" in requests.columns else wave_of(waves)
    for n in range(waves):
        asked = requests.filter(own == n)
        if not asked.select("call_id").isEmpty():
            store.commit(judge(asked, fn, factory, only_answers=True))


# ---- answers --------------------------------------------------------------
def response_text(response: Column, provider: Column | str) -> Column:
    """The model's own text inside a response body, by provider shape."""
    body = F.try_parse_json(response)
    chat = F.try_variant_get(body, "$.choices[0].message.content", "string")
    parts = F.coalesce(F.try_variant_get(body, "$.content", "array<variant>"), F.array().cast("array<variant>"))
    texts = F.transform(
        F.filter(parts, lambda p: F.try_variant_get(p, "$.type", "string") == "text"),
        lambda p: F.coalesce(F.try_variant_get(p, "$.text", "string"), F.lit("")),
    )
    blocks = F.array_join(texts, "")
    if isinstance(provider, str):
        if provider not in PROVIDERS:
            raise ValueError(f"unknown provider {provider!r}")
        return chat if provider == "openai" else blocks
    return F.when(provider == "openai", chat).otherwise(blocks)


def answers_array(response: Column, provider: Column | str) -> Column:
    """``results[]`` of a response as ARRAY<VARIANT>; null when the text is not such JSON."""
    return F.try_variant_get(
        F.try_parse_json(response_text(response, provider)), "$.results", "array<variant>"
    )


def unpack(responses: DataFrame, provider: Column | str, mode: str = "failfast") -> DataFrame:
    """One row per answer: ``call_id, position, event_id, result`` (VARIANT).

    ``failfast`` raises when a response holds no ``results`` array; ``quarantine``
    keeps one row with ``is_invalid`` set for it.
    """
    if mode not in ("failfast", "quarantine"):
        raise ValueError("mode must be 'failfast' or 'quarantine'")
    parsed = responses.withColumn("_answers", answers_array(F.col("response"), provider))
    bad = F.col("_answers").isNull()
    if mode == "failfast":
        boom = F.raise_error(F.concat(F.lit("response without a results array: "), F.col("call_id")))
        parsed = parsed.withColumn(
            "_answers", F.when(bad, boom.cast("array<variant>")).otherwise(F.col("_answers"))
        )
        # Outer, then filtered: an inner explode would have the array computed a second time to test its size.
        rows = parsed.select("call_id", F.posexplode_outer("_answers").alias("position", "_a")).filter(
            F.col("position").isNotNull()
        )
        flag: list[Column] = []
    else:
        rows = parsed.select("call_id", bad.alias("is_invalid"), F.posexplode_outer("_answers").alias("position", "_a"))
        flag = [F.col("is_invalid")]
    return rows.select(
        "call_id",
        *flag,
        "position",
        string_at(F.col("_a"), "$.event_id").alias("event_id"),
        F.try_variant_get("_a", "$.result", "variant").alias("result"),
    )


def last_answer(answers: DataFrame, keys: tuple[str, ...] = ("call_id", "event_id"),
                order: tuple[str, ...] = ("position",)) -> DataFrame:
    """Last answer per key; answers without an event id drop out.

    ``max_by`` combines map-side, so a key repeated without bound stays one row per task.
    """
    rest = [c for c in answers.columns if c not in keys]
    kept = answers.filter(F.coalesce(F.col("event_id"), F.lit("")) != "")
    return (
        kept.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
        .select(*keys, "_last.*")
    )


def decision_summary(answers: DataFrame, keys: tuple[str, ...] = ("call_id",)) -> DataFrame:
    """Verdict counts per call over the raw answers; whatever is not pass or fail is ``other``."""
    verdict = string_at(F.col("result"), "$.result")
    return answers.groupBy(*keys).agg(
        F.count_if(verdict == "pass").alias("pass"),
        F.count_if(verdict == "fail").alias("fail"),
        F.count_if(~F.coalesce(verdict.isin("pass", "fail"), F.lit(False))).alias("other"),
    )


def default_answer(check_name: Column, event_id: Column) -> Column:
    """Stand-in for a missing or unusable answer, as MAP<STRING, VARIANT>."""
    v = lambda c: c.cast("variant")
    return F.create_map(
        F.lit("check_name"), v(check_name),
        F.lit("check_version"), v(F.lit("v1")),
        F.lit("event_id"), v(event_id),
        F.lit("result"), v(F.lit("fail")),
        F.lit("confidence"), v(F.lit(0.0)),
        F.lit("reason"), v(F.lit(DEFAULT_REASON)),
    )


def finish_answer(answer: Column, check_name: Column, event_id: Column, prompt_version: Column) -> Column:
    """The stored verdict: the answer's object or the default, with the row's own event id,
    and check name and version filled in only where the judge left them out."""
    absent = F.create_map(
        F.lit("check_name"), check_name.cast("variant"), F.lit("check_version"), prompt_version.cast("variant")
    )

    def complete(given: Column) -> Column:
        return F.map_concat(
            F.map_filter(given, lambda k, _: k != "event_id"),
            F.create_map(F.lit("event_id"), event_id.cast("variant")),
            F.map_filter(absent, lambda k, _: ~F.map_contains_key(given, k)),
        )

    filled = let(object_at(answer), complete)
    return F.to_variant_object(F.coalesce(filled, default_answer(check_name, event_id)))


def attach_answers(rows: DataFrame, answers: DataFrame, prompt_version: Column | None = None) -> DataFrame:
    """Rows (``call_id, check_name, event_id, ...``) left-joined to the last answer of their call.

    Adds ``llm_check``; rows without a usable answer get the default verdict.
    """
    best = last_answer(answers).select("call_id", "event_id", F.col("result").alias("_answer"))
    version = F.col("prompt_version") if prompt_version is None else prompt_version
    return (
        rows.join(best, ["call_id", "event_id"], "left")
        .withColumn("llm_check", finish_answer(F.col("_answer"), F.col("check_name"), F.col("event_id"), version))
        .drop("_answer")
    )


def usage_column(response: Column) -> Column:
    """``usage`` of a response body as VARIANT; an empty object when it is no object."""
    body = F.try_parse_json(response)
    usage = let(F.try_variant_get(body, "$.usage", "variant"), lambda u: F.when(is_object(u), u))
    return F.coalesce(usage, F.parse_json(F.lit("{}")))


def with_call_metrics(calls: DataFrame) -> DataFrame:
    """Adds ``usage`` (VARIANT) and ``cost_usd`` to judged calls."""

    def tokens(name: str) -> Column:
        usage = F.col("usage")
        is_int = F.schema_of_variant(F.try_variant_get(usage, f"$.{name}", "variant")) == "BIGINT"
        return F.when(is_int, F.try_variant_get(usage, f"$.{name}", "bigint"))

    return calls.withColumn("usage", usage_column(F.col("response"))).withColumn(
        "cost_usd",
        cost_column(F.col("provider"), F.col("model"), tokens("prompt_tokens"), tokens("completion_tokens")),
    )


def metrics_struct(n_rows: Column) -> Column:
    """Per-row share of a call plus the call's own figures."""
    return F.struct(
        F.try_divide(F.col("latency_ms"), n_rows).alias("estimated_latency_ms_per_row"),
        F.try_divide(F.col("cost_usd"), n_rows).alias("estimated_cost_usd_per_row"),
        F.col("latency_ms").alias("call_latency_ms"),
        F.col("usage").alias("call_usage"),
    )


def enrich(rows: DataFrame, run_id: str, prompt_version: Column, prompt_file: Column, model: Column,
           metrics: Column) -> DataFrame:
    """Adds the result envelope around ``llm_check``."""
    return rows.withColumns(
        {
            "run_id": F.lit(run_id),
            "prompt_version": prompt_version,
            "prompt_file": prompt_file,
            "created_at": F.current_timestamp(),
            "model": model,
            "llm_metrics": metrics,
        }
    )


def verdict_columns(results: DataFrame, strict: bool = True) -> DataFrame:
    """Lifts ``event_id, result, confidence, reason`` out of the open ``llm_check``."""
    check = F.col("llm_check")
    return results.withColumns(
        {
            "event_id": string_at(check, "$.event_id"),
            "result": string_at(check, "$.result"),
            "confidence": number_at(check, "$.confidence", strict),
            "reason": F.try_variant_get(check, "$.reason", "string"),
        }
    )


def not_processed(rows: DataFrame, done: DataFrame) -> DataFrame:
    """Resume: rows whose event id is not yet among the processed ones."""
    return rows.join(processed_ids(done), "event_id", "left_anti")


def processed_ids(results: DataFrame) -> DataFrame:
    return results.select("event_id").filter(F.col("event_id").isNotNull()).distinct()
