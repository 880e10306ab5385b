"""Filling missing values: a prompt per row that needs one, a user's batch generator, parsed, validated, merged back.

Rows with nothing missing never reach the generator. Equal prompts are asked once: answers are kept in a store, a table
keyed by the SHA-256 of the prompt and its fields. Prompts are asked in rounds, each of which is added to the store when it
is done; a run that was broken off goes on where it stopped when it is given the same store, and asks again only what its
last round had begun. ``infer`` evaluates its input once, writes the answered rows as a table and returns that table as read
back: whatever is made of it (results, statistics, errors, merged records) sees the same answers.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotframe.schema import NA, infer_missing
from lotframe.sources.shared import fresh_path, written

# The default fields, the interface of a listing, and the wording of the prompt.
DEFAULT_FIELDS = ("engine", "interior_color", "location", "seller_type")
INTERFACE: dict[str, str | list[str]] = {
    "source": ["BringATrailer"],
    "seller_type": ["Private Party", "Dealer"],
    "result": ["Sold", "Reserve Not Met"],
    "price": "integer",
    "number_of_bids": "integer",
    "year": "integer",
    "mileage": "integer",
    "sale_date": "datetime",
    "convertible": "boolean",
    "listing_details": "string[]",
    "excerpt": "string[]",
}
WORDING = {"integer": ("integer", "0"), "boolean": ("true or false", "true"), "datetime": ("datetime string (YYYY-MM-DD)", '"YYYY-MM-DD"'), "string": ("string", '"..."')}
PROMPT = (
    "Given this car listing data, infer the missing {word} ({names}) based on the listing_details and excerpt.\n\n"
    "Listing Details:\n{details}\n\nExcerpt:\n{excerpt}\n\n"
    "Extract and return ONLY a valid JSON object with these {count} {word}:\n{spec}\n\n"
    "For enum fields, use ONLY the specified values.\nFor other fields, use null if you cannot infer the value.\n\n"
    "Return ONLY the JSON object in this format, no other text:\n{{\n{template}\n}}"
)
TRUE_WORDS = ("true", "yes", "1")
Interface = dict[str, "str | list[str]"]


def na_fields(df: DataFrame, fields: Sequence[str] = DEFAULT_FIELDS) -> Column:
    """The names of the fields that a row lacks, in the order asked."""
    have = {f.name: f.dataType for f in df.schema}
    flags = [F.when(infer_missing(F.col(f), have[f]), F.lit(f)) if f in have else F.lit(f) for f in fields]
    return F.filter(F.array(*flags), lambda x: x.isNotNull())


def _spec(field: str, interface: Interface) -> tuple[str, str]:
    kind = interface.get(field, "string")
    if isinstance(kind, list):
        options = ", ".join(f'"{o}"' for o in kind)
        return f'    "{field}": one of [{options}]', f'    "{field}": "..."'
    say, show = WORDING.get(kind, WORDING["string"])
    return f'    "{field}": {say}', f'    "{field}": {show}'


def prompt(missing: Column, details: Column, excerpt: Column, fields: Sequence[str] = DEFAULT_FIELDS, interface: Interface | None = None) -> Column:
    """The prompt for a row's missing fields, as one expression."""
    interface = INTERFACE if interface is None else interface
    lines = {f: _spec(f, interface) for f in fields}

    def each(at: int) -> Column:
        known = F.create_map(*(F.lit(x) for f in fields for x in (f, lines[f][at])))
        return F.array_join(F.transform(missing, lambda f: F.try_element_at(known, f)), ",\n")

    n = F.size(missing)
    parts = {
        "word": F.when(n == 1, "field").otherwise("fields"),
        "names": F.array_join(F.transform(missing, lambda f: F.concat(F.lit('"'), f, F.lit('"'))), ", "),
        "details": F.coalesce(F.array_join(details, "\n"), F.lit("")),
        "excerpt": F.coalesce(F.array_join(excerpt, "\n"), F.lit("")),
        "count": n.cast("string"),
        "spec": each(0),
        "template": each(1),
    }
    pieces = re.split(r"\{(\w+)\}", PROMPT.replace("{{", "\0").replace("}}", "\1"))
    text = [parts[p] if i % 2 else F.lit(p.replace("\0", "{").replace("\1", "}")) for i, p in enumerate(pieces)]
    return F.concat(*text)


def with_prompts(df: DataFrame, fields: Sequence[str] = DEFAULT_FIELDS, interface: Interface | None = None) -> DataFrame:
    """Adds na_fields, skipped_fields and prompt (null where nothing is missing)."""
    rows = df.withColumn("na_fields", na_fields(df, fields))
    asked = F.array(*map(F.lit, fields))
    text = prompt(F.col("na_fields"), F.col("listing_details"), F.col("excerpt"), fields, interface)
    return rows.withColumns({"skipped_fields": F.array_except(asked, "na_fields"), "prompt": F.when(F.size("na_fields") > 0, text)})


# answers

_FLAT = re.compile(r"\{[^{}]*\}", re.S)


def parse_answer(text: str, expected: Iterable[str]) -> dict:
    """The first flat {...} as JSON, else the whole text; expected fields that are not there are null. Raises ValueError."""
    found = _FLAT.search(text)
    for candidate in ([found.group()] if found else []) + [text]:
        try:
            value = json.loads(candidate)
        except json.JSONDecodeError:
            continue
        if not isinstance(value, dict):
            raise ValueError(f"answer is no JSON object: {text[:200]}")
        return {**dict.fromkeys(expected), **value}
    raise ValueError(f"no JSON in the answer: {text[:200]}")


def validate_value(value, kind: str | list[str]):
    """A value as its field's type allows it, else null; text that says neither true nor false is false."""
    if isinstance(kind, list):
        return value if value in kind else None
    if kind == "integer":
        try:
            return None if value is None else int(value)
        except (ValueError, TypeError, OverflowError):
            return None
    if kind == "boolean":
        return value if isinstance(value, bool) else value.lower() in TRUE_WORDS if isinstance(value, str) else None
    return value


def _text(value) -> str | None:
    return None if value is None else value if isinstance(value, str) else json.dumps(value)


#: Parts in which prompts are asked; each is kept when it is done.
ROUNDS = 4
ANSWER = T.StructType([T.StructField("_key", T.StringType()), T.StructField("inferred", T.MapType(T.StringType(), T.StringType())), T.StructField("attempts", T.IntegerType()), T.StructField("error", T.StringType())])


def ask(text: str, missing: Sequence[str], generate: Callable[[str], str], interface: Interface, max_retries: int) -> tuple[dict, int, str | None]:
    """(values as text by field, attempts, error) of one prompt."""
    error = None
    for tried in range(1, max_retries + 1):
        try:
            answer = parse_answer(generate(text), missing)
            return {f: _text(validate_value(answer.get(f), interface.get(f, "string"))) for f in missing}, tried, None
        except Exception as e:
            error = str(e)
    return {}, max_retries, error


def infer(
    df: DataFrame,
    generate: Callable[[str], str],
    fields: Sequence[str] = DEFAULT_FIELDS,
    interface: Interface | None = None,
    max_retries: int = 3,
    parallelism: int | None = None,
    path: str | None = None,
    store: str | None = None,
    rounds: int = ROUNDS,
    ask_failed: bool = False,
) -> DataFrame:
    """Adds na_fields, skipped_fields, prompt, and inferred (values as text; other JSON as its JSON text), attempts and error.
    ``generate`` runs on the executors, which are sent prompts and names of fields only; it and the parsing are tried
    ``max_retries`` times. ``store``: where answers are kept, for this run and later ones; ``ask_failed``: prompts whose stored
    answer is an error are asked again. The answered rows are written to ``path``, or to a new one in the shared folder, and
    read back; there, the prompt is left out and made of the other columns when it is read. attempts are those of the answer,
    which rows of equal prompts share."""
    spark = df.sparkSession
    interface = INTERFACE if interface is None else interface
    store = store or fresh_path(spark, "answer-store")
    rows = with_prompts(df, fields, interface).withColumn("_key", F.sha2(F.concat_ws("\0", F.array_join("na_fields", "\0"), "prompt"), 256))
    rows = rows.withColumn("_key", F.when(F.col("prompt").isNotNull(), F.col("_key"))).drop("prompt")
    # written, as a condition on the key would be pushed below it and evaluate what the rows are made of once for each mention
    rows = written(rows, fresh_path(spark, "rows"))
    text = prompt(F.col("na_fields"), F.col("listing_details"), F.col("excerpt"), fields, interface)
    # by hashing: a task holds its different questions, not its rows; written, as else Spark would see one aggregation, by sorting
    needy = rows.where("_key IS NOT NULL").select("_key", "na_fields", "listing_details", "excerpt").distinct()
    needy = written(needy, fresh_path(spark, "needy"))
    questions = needy.select("_key", "na_fields", text.alias("prompt")).groupBy("_key").agg(F.first("prompt").alias("prompt"), F.first("na_fields").alias("na_fields"))
    questions = written(questions.withColumn("round", F.pmod(F.xxhash64("_key"), F.lit(rounds)).cast("int")), fresh_path(spark, "questions"))

    def answers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            some = [(k, *ask(p, list(m), generate, interface, max_retries)) for k, p, m in zip(batch["_key"], batch["prompt"], batch["na_fields"], strict=True)]
            yield pd.DataFrame(some, columns=ANSWER.names)

    for number in range(rounds):
        known = answer_store(spark, store)
        todo = questions.where(F.col("round") == number).drop("round").join((known.where("error IS NULL") if ask_failed else known).select("_key"), "_key", "left_anti")
        todo = todo.repartition(parallelism) if parallelism else todo
        todo.mapInPandas(answers, ANSWER).write.mode("append").parquet(store)
    found = answer_store(spark, store)
    best = F.max_by(F.struct("inferred", "attempts", "error"), F.struct(F.col("error").isNull(), "attempts")).alias("a")  # a later good answer counts
    found = found.groupBy("_key").agg(best).select("_key", "a.*")
    none = {"inferred": F.create_map().cast("map<string,string>"), "attempts": F.lit(0)}
    asked = rows.where("_key IS NOT NULL").join(found, "_key", "left").withColumns({n: F.coalesce(n, c) for n, c in none.items()})
    complete = rows.where("_key IS NULL").withColumns({**none, "error": F.lit(None).cast("string")})  # these would all meet in one task of the join
    done = asked.unionByName(complete).drop("_key")
    prompted = F.when(F.size("na_fields") > 0, text)
    names = [*(c for c in rows.columns if c != "_key"), "prompt", "inferred", "attempts", "error"]
    if path:
        return written(done.withColumn("prompt", prompted).select(names), path)
    return written(done, fresh_path(spark, "answers")).withColumn("prompt", prompted).select(names)


def answer_store(spark: SparkSession, path: str) -> DataFrame:
    """(_key, inferred, attempts, error) of the answers kept so far; none if nothing was kept yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(ANSWER).parquet(path) if there else spark.createDataFrame([], ANSWER)


def merge(answered: DataFrame) -> DataFrame:
    """Writes inferred values into the record: only where the answer had no error, the value is there, and the field holds
    exactly N/A (null and blank fields are inferred but stay)."""
    kinds = {f.name: f.dataType for f in answered.schema}
    extra = {"na_fields", "skipped_fields", "prompt", "inferred", "attempts", "error"}
    columns = []
    for c in answered.columns:
        if c in extra:
            continue
        if isinstance(kinds[c], T.StringType):
            value = F.try_element_at("inferred", F.lit(c))
            columns.append(F.when((F.col(c) == NA) & value.isNotNull() & F.col("error").isNull(), value).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(c))
    return answered.select(*columns)


def results(answered: DataFrame, fields: Sequence[str] = DEFAULT_FIELDS, pos: str = "_pos") -> DataFrame:
    """The result table: index, url, title, inferred_values (existing values of the other fields included), lists, error."""
    have = [f for f in fields if f in answered.columns]
    existing = F.map_filter(F.create_map(*(x for f in have for x in (F.lit(f), F.col(f).cast("string")))), lambda k, v: F.array_contains("skipped_fields", k))
    return answered.select(
        F.col(pos).alias("index"),
        "url",
        "title",
        F.map_concat(existing, "inferred").alias("inferred_values"),
        F.col("na_fields").alias("fields_inferred"),
        F.col("skipped_fields").alias("fields_skipped"),
        "attempts",
        "error",
    )


def errors(result_table: DataFrame) -> DataFrame:
    return result_table.where("error is not null").select("index", F.col("error").alias("message"))


def run_stats(result_table: DataFrame, fields: Sequence[str] = DEFAULT_FIELDS) -> DataFrame:
    """One row: total_entries, entries_with_na, entries_skipped, llm_calls, successful, failed, and fields_inferred (map of
    non-null inferred values by field)."""
    needy = F.size("fields_inferred") > 0

    def filled(f: str) -> Column:
        return F.count_if(F.array_contains("fields_inferred", f) & F.try_element_at("inferred_values", F.lit(f)).isNotNull() & F.col("error").isNull())

    calls = F.sum("attempts") if "attempts" in result_table.columns else F.count_if(needy)
    totals = result_table.agg(
        F.count("*").alias("total_entries"),
        F.count_if(needy).alias("entries_with_na"),
        F.count_if(~needy).alias("entries_skipped"),
        F.coalesce(calls, F.lit(0)).cast("long").alias("llm_calls"),
        F.count_if(F.col("error").isNull()).alias("successful"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
        *(filled(f).alias(f"_{f}") for f in fields),
    )
    return totals.withColumn("fields_inferred", F.create_map(*(x for f in fields for x in (F.lit(f), F.col(f"_{f}"))))).drop(*(f"_{f}" for f in fields))
