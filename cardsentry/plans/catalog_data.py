"""Queries: sources and sinks, validation, splitting, sampling, preprocessing."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardsentry.functions.scalar import micros
from cardsentry.operators import preprocess as P
from cardsentry.operators import quality as Q
from cardsentry.operators import split as SP
from cardsentry.operators.features import fill_zero
from cardsentry.plans.catalog import PARTS, query, r6, s6, with_txn
from cardsentry.schema import LABEL, REQUIRED_COLUMNS, TIME
from cardsentry.session import materialise, scratch_path
from cardsentry.sources import files
from cardsentry.sources.tables import table, transactions

US = "epoch_us(trans_date_trans_time)"


def _required(spark, sf_dir):
    return transactions(spark, sf_dir).select(*REQUIRED_COLUMNS)


@query(
    "scan_transactions",
    with_txn(
        f"SELECT trans_num, cc_num, merchant, {s6('amt')} AS amt, city_pop, is_fraud, {US} AS us, dob::VARCHAR AS dob, first, last FROM txn"
    ),
)
def _scan_transactions(spark, sf_dir):
    """Written as CSV, then loaded: types restored, columns validated, ids unique."""
    path = scratch_path(spark, "transactions-csv")
    files.write_transactions_csv(_required(spark, sf_dir), path)
    df = files.load_transactions(spark, path)
    return df.select(
        "trans_num", "cc_num", "merchant", r6("amt").alias("amt"), "city_pop", "is_fraud",
        micros(F.col(TIME)).alias("us"), F.col("dob").cast("string").alias("dob"), "first", "last",
    )


@query("parse_datetimes", with_txn(f"SELECT trans_num, {US} AS us, dob::VARCHAR AS dob FROM txn"))
def _parse_datetimes(spark, sf_dir):
    texts = transactions(spark, sf_dir).select("trans_num", F.col(TIME).cast("string").alias(TIME), F.col("dob").cast("string").alias("dob"))
    return files.parse_datetimes(texts).select("trans_num", micros(F.col(TIME)).alias("us"), F.col("dob").cast("string").alias("dob"))


EVENT_JSON = T.StructType([T.StructField("k", T.IntegerType())])


@query(
    "scan_stream_jsonl",
    "SELECT count(*) AS good, sum(json_extract_string(props, '$.k')::INT)::BIGINT AS sum_k, "
    "(SELECT count(*) FROM events WHERE event_id % 10 = 0) AS bad FROM events WHERE event_id % 10 NOT IN (0, 1)",
)
def _scan_stream_jsonl(spark, sf_dir):
    """The JSON texts of all events as a file, with every tenth line cut short and another tenth blank."""
    path = scratch_path(spark, "lines")
    line = (
        F.when(F.col("event_id") % 10 == 0, F.expr("substr(props, 1, 4)"))
        .when(F.col("event_id") % 10 == 1, "")
        .otherwise(F.col("props"))
    )
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    rows = files.read_jsonl(spark, path, EVENT_JSON)
    bad = F.col(files.BAD_RECORD).isNotNull()
    return rows.agg(F.count_if(~bad).alias("good"), F.sum("k").alias("sum_k"), F.count_if(bad).alias("bad"))


@query(
    "scan_jsonl_limit",
    "SELECT event_id, json_extract_string(props, '$.k')::INT AS k FROM events WHERE event_id % 10 NOT IN (0, 1, 2) "
    "QUALIFY row_number() OVER (ORDER BY event_id) <= (SELECT count(*) // 3 FROM events)",
)
def _scan_jsonl_limit(spark, sf_dir):
    """The first valid third of the events' JSON lines, among lines that are broken, blank or lack a field."""
    path = scratch_path(spark, "lines")
    events = table(spark, sf_dir, "events")
    whole = F.to_json(F.struct("event_id", F.get_json_object("props", "$.k").cast("int").alias("k")))
    line = (
        F.when(F.col("event_id") % 10 == 0, F.substring(whole, 1, 9))
        .when(F.col("event_id") % 10 == 1, "")
        .when(F.col("event_id") % 10 == 2, F.to_json(F.struct("event_id")))
        .otherwise(whole)
    )
    events.repartitionByRange(7, "event_id").sortWithinPartitions("event_id").select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("k", T.IntegerType())])
    return files.read_jsonl(spark, path, schema, limit=events.count() // 3, valid=F.col("k").isNotNull())


@query(
    "scan_stream_kafka",
    "SELECT event_id % 7 AS part, count(*) AS n, sum(json_extract_string(props, '$.k')::INT)::BIGINT AS sum_k FROM events GROUP BY 1",
)
def _scan_stream_kafka(spark, sf_dir):
    """The parse stage of the topic reader, on messages made of all events (no broker is needed for it)."""
    from cardsentry.sources.kafka import parse_messages

    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("props", T.StringType())])
    messages = files.to_json_text(table(spark, sf_dir, "events").select("event_id", "props"))
    parsed = parse_messages(messages.select(F.col("value").cast("binary").alias("value")), schema)
    k = F.get_json_object("props", "$.k").cast("int")
    return parsed.groupBy((F.col("event_id") % 7).alias("part")).agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("sum_k"))


def _replayed_sql() -> str:
    return with_txn(
        f"SELECT trans_num, cc_num, {s6('amt')} AS amt, first, last, strftime(trans_date_trans_time, '%Y-%m-%d %H:%M:%S') AS at, dob::VARCHAR AS dob FROM txn"
    )


@query("sink_stream_jsonl", _replayed_sql())
def _sink_stream_jsonl(spark, sf_dir):
    path = scratch_path(spark, "replay")
    files.write_jsonl(_required(spark, sf_dir), path)
    texts = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in (TIME, "dob") else f.dataType) for f in _required(spark, sf_dir).schema.fields]
    )
    back, _ = files.good_and_bad(files.read_jsonl(spark, path, texts))
    return back.select(
        "trans_num", "cc_num", r6("amt").alias("amt"), "first", "last", F.substring(TIME, 1, 19).alias("at"), "dob"
    )


@query(
    "sink_stream_kafka",
    with_txn(f"SELECT trans_num, cc_num, {s6('amt')} AS amt, last FROM txn"),
)
def _sink_stream_kafka(spark, sf_dir):
    """The message texts of the topic writer, read back."""
    texts = files.to_json_text(_required(spark, sf_dir))
    get = lambda k: F.get_json_object("value", f"$.{k}")
    return texts.select(
        get("trans_num").alias("trans_num"), get("cc_num").cast("long").alias("cc_num"),
        r6(get("amt").cast("double")).alias("amt"), get("last").alias("last"),
    )


SAMPLE = """hashed AS (SELECT *, ('0x' || substr(md5(trans_num), 1, 8))::BIGINT h FROM txn),
ranked AS (SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY h, trans_num) rn FROM hashed),
have AS (SELECT sum(is_fraud)::BIGINT pos, (count(*) - sum(is_fraud))::BIGINT neg FROM txn),
quota AS (SELECT least(pos, 8000 - least(neg, 8000 - least(136, pos))) p, least(neg, 8000 - least(136, pos)) q FROM have),
sampled AS (SELECT ranked.* FROM ranked, quota WHERE rn <= CASE WHEN is_fraud = 1 THEN p ELSE q END)"""


@query(
    "write_csv_sample",
    with_txn(f"SELECT trans_num, {s6('amt')} AS amt, is_fraud FROM sampled", SAMPLE),
)
def _write_csv_sample(spark, sf_dir):
    """The stratified sample, of a bounded number of rows, as one file."""
    path = scratch_path(spark, "sample-csv")
    files.write_transactions_csv(SP.stratified_sample(_required(spark, sf_dir)), path, single_file=True)
    return files.read_transactions_csv(spark, path).select("trans_num", r6("amt").alias("amt"), "is_fraud")


SPARK_TYPES = {
    "trans_date_trans_time": "timestamp", "cc_num": "bigint", "amt": "double", "lat": "double", "long": "double",
    "city_pop": "bigint", "dob": "date", "merch_lat": "double", "merch_long": "double", "is_fraud": "int",
}


def _schema_report_sql() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", true AS present, '{SPARK_TYPES.get(c, 'string')}' AS type, true AS type_ok, "
        f"count_if({c} IS NULL)::BIGINT AS null_count FROM txn"
        for c in REQUIRED_COLUMNS
    )
    return with_txn(rows)


@query("schema_report", _schema_report_sql())
def _schema_report(spark, sf_dir):
    return Q.schema_report(transactions(spark, sf_dir))


@query(
    "null_profile",
    with_txn(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count_if({c} IS NULL)::BIGINT AS null_count FROM txn" for c in REQUIRED_COLUMNS)),
)
def _null_profile(spark, sf_dir):
    return Q.null_profile(_required(spark, sf_dir))


@query(
    "dedup_transactions",
    with_txn(
        "SELECT pair, event_id, amt FROM (SELECT *, cc_num::VARCHAR || '-' || category AS pair, "
        "row_number() OVER (PARTITION BY cc_num, category ORDER BY event_id) rn FROM txn) WHERE rn = 1"
    ),
)
def _dedup_transactions(spark, sf_dir):
    """Card and category as the id, so that there are many copies; the first one in input order stays."""
    df = transactions(spark, sf_dir)
    pair = F.concat_ws("-", F.col("cc_num").cast("string"), "category").alias("pair")
    return Q.dedup_first(df.select(pair, "event_id", "amt"), "pair", "event_id")


@query(
    "dataset_stats",
    with_txn(f"SELECT count(*) AS n_rows, 19 AS n_cols, sum(is_fraud)::BIGINT AS fraud_count, {s6('100 * avg(is_fraud)')} AS fraud_ratio_pct FROM txn"),
)
def _dataset_stats(spark, sf_dir):
    return Q.dataset_stats(_required(spark, sf_dir)).withColumn("fraud_ratio_pct", r6("fraud_ratio_pct"))


@query(
    "validate_required_fields",
    with_txn(
        "SELECT CASE WHEN event_id % 5 = 0 AND event_id % 3 = 0 THEN 'cc_num,amt' WHEN event_id % 5 = 0 THEN 'cc_num' "
        "WHEN event_id % 3 = 0 THEN 'amt' ELSE '' END AS missing_fields, count(*) AS n FROM txn GROUP BY 1"
    ),
)
def _validate_required_fields(spark, sf_dir):
    df = transactions(spark, sf_dir)
    holes = df.withColumns(
        {
            "cc_num": F.when(F.col("event_id") % 5 != 0, F.col("cc_num")),
            "amt": F.when(F.col("event_id") % 3 != 0, F.col("amt")),
        }
    )
    valid, rejected = Q.validate_required_fields(holes)
    both = valid.withColumn("missing_fields", F.lit("")).unionByName(rejected)
    return both.groupBy("missing_fields").agg(F.count(F.lit(1)).alias("n"))


@query("drop_columns", with_txn("SELECT cc_num, category, amt, is_fraud FROM txn"))
def _drop_columns(spark, sf_dir):
    df = transactions(spark, sf_dir).select("trans_num", "first", "last", "cc_num", "category", "amt", "is_fraud")
    return P.drop_columns(df)


@query(
    "fill_nulls",
    with_txn("SELECT trans_num, CASE WHEN event_id % 4 = 0 THEN 0 ELSE amt END::DOUBLE AS amt, 0::DOUBLE AS nothing FROM txn"),
)
def _fill_nulls(spark, sf_dir):
    df = transactions(spark, sf_dir)
    amt = F.when(F.col("event_id") % 4 != 0, F.col("amt")).when(F.col("event_id") % 8 == 0, F.lit(float("nan")))
    holes = df.select("trans_num", amt.alias("amt"), F.lit(None).cast("int").alias("nothing"))
    return fill_zero(holes, ["amt", "nothing"])


@query("filter_class", with_txn("SELECT trans_num, amt FROM txn WHERE is_fraud = 0"))
def _filter_class(spark, sf_dir):
    return transactions(spark, sf_dir).where(F.col(LABEL) == 0).select("trans_num", "amt")


# --- order, split, sample -------------------------------------------------------------------------------------------


@query("sort_by_time", with_txn(f"SELECT trans_num, {US} AS us FROM txn ORDER BY us, trans_num"))
def _sort_by_time(spark, sf_dir):
    df = transactions(spark, sf_dir).select("trans_num", TIME)
    return SP.sort_by_time(df).select("trans_num", micros(F.col(TIME)).alias("us"))


@query("limit_n", with_txn("SELECT trans_num, amt FROM txn ORDER BY trans_date_trans_time, trans_num LIMIT 100"))
def _limit_n(spark, sf_dir):
    return SP.sort_by_time(transactions(spark, sf_dir)).select("trans_num", "amt").limit(100)


@query("time_split", with_txn("SELECT trans_num, split FROM parts", PARTS))
def _time_split(spark, sf_dir):
    return SP.time_split(transactions(spark, sf_dir)).select("trans_num", "split")


@query(
    "split_summary",
    with_txn(
        f"SELECT split, count(*) AS n, min({US}) AS min_us, max({US}) AS max_us, {s6('100 * avg(is_fraud)')} AS fraud_rate_pct FROM parts GROUP BY split",
        PARTS,
    ),
)
def _split_summary(spark, sf_dir):
    out = SP.split_summary(SP.time_split(transactions(spark, sf_dir)))
    return out.withColumn("fraud_rate_pct", r6("fraud_rate_pct"))


@query("stratified_sample", with_txn("SELECT trans_num, is_fraud FROM sampled", SAMPLE))
def _stratified_sample(spark, sf_dir):
    return SP.stratified_sample(transactions(spark, sf_dir)).select("trans_num", "is_fraud")


@query("union_classes", with_txn("SELECT trans_num, is_fraud, amt FROM txn"))
def _union_classes(spark, sf_dir):
    df = transactions(spark, sf_dir).select("trans_num", "is_fraud", "amt")
    return df.where("is_fraud = 1").unionByName(df.where("is_fraud = 0"))


# --- preprocessing --------------------------------------------------------------------------------------------------

NUMBERS = ["amt", "lat", "long", "city_pop", "merch_lat", "merch_long", "age"]
AGE = "(date_diff('day', dob, trans_date_trans_time::DATE) / 365.25::DOUBLE)"
AGED = f"aged AS (SELECT *, {AGE} age FROM txn)"
# every third amount and every seventh job is taken away before fitting
HOLES = "holes AS (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN NULL ELSE amt END AS amt, CASE WHEN event_id % 7 = 0 THEN NULL ELSE job END AS job) FROM aged)"


def _holes(spark, sf_dir):
    df = P.with_age(transactions(spark, sf_dir))
    return df.withColumns(
        {"amt": F.when(F.col("event_id") % 3 != 0, F.col("amt")), "job": F.when(F.col("event_id") % 7 != 0, F.col("job"))}
    )


@query(
    "impute_median",
    with_txn(
        "SELECT trans_num, " + ", ".join(s6(f"coalesce({c}, (SELECT median({c}::DOUBLE) FROM holes))") + f" AS {c}" for c in NUMBERS) + " FROM holes",
        AGED,
        HOLES,
    ),
)
def _impute_median(spark, sf_dir):
    df = _holes(spark, sf_dir)
    out = P.impute(df, P.fit_medians(df, NUMBERS))
    return out.select("trans_num", *[r6(c).alias(c) for c in NUMBERS])


@query("fill_unknown", with_txn("SELECT trans_num, coalesce(job, 'unknown') AS job, coalesce(last, 'unknown') AS last FROM holes", AGED, HOLES))
def _fill_unknown(spark, sf_dir):
    return P.fill_unknown(_holes(spark, sf_dir), ["job", "last"]).select("trans_num", "job", "last")


def _code(column: str, fitted: str) -> str:
    return f"coalesce((SELECT code FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 code FROM (SELECT DISTINCT {column} v FROM {fitted})) k WHERE k.v = t.{column}), -1)"


@query(
    "ordinal_encode",
    with_txn(
        "SELECT trans_num, " + ", ".join(f"{_code(c, 'known')}::BIGINT AS {c}" for c in P.CODED) + " FROM txn t",
        "known AS (SELECT * FROM txn WHERE merchant <> 'merchant_7' AND city < 'city_5')",
    ),
)
def _ordinal_encode(spark, sf_dir):
    """Fitted without some merchants and cities, which therefore become -1."""
    df = transactions(spark, sf_dir)
    codes = materialise(P.ordinal_codes(df.where("merchant <> 'merchant_7' AND city < 'city_5'"), P.CODED))
    return P.apply_codes(df, codes, P.CODED).select("trans_num", *[F.col(c).cast("long").alias(c) for c in P.CODED])


CATEGORIES = ["click", "error", "purchase", "signup", "view"]


def _one_hot_sql(source: str) -> str:
    cells = [f"(category = '{v}')::INT::DOUBLE AS category_{v}" for v in CATEGORIES]
    cells += [f"(gender = '{v}')::INT::DOUBLE AS gender_{v}" for v in "FM"]
    return ", ".join(cells)


@query("one_hot", with_txn(f"SELECT trans_num, {_one_hot_sql('txn')} FROM txn"))
def _one_hot(spark, sf_dir):
    df = transactions(spark, sf_dir)
    cells = P.indicators(df, P.indicator_levels(df, P.INDICATED))
    return df.select("trans_num", *[x.alias(c) for c, x in cells.items()])


def _robust(column: str, fitted: str) -> str:
    q = lambda p: f"(SELECT quantile_cont({column}::DOUBLE, {p}) FROM {fitted})"
    return f"({column} - {q(0.5)}) / coalesce(nullif({q(0.75)} - {q(0.25)}, 0), 1)"


@query("robust_scale", with_txn("SELECT trans_num, " + ", ".join(f"{s6(_robust(c, 'aged'))} AS {c}" for c in NUMBERS) + " FROM aged", AGED))
def _robust_scale(spark, sf_dir):
    df = P.with_age(transactions(spark, sf_dir))
    return P.robust_scale(df, P.fit_robust_scale(df, NUMBERS)).select("trans_num", *[r6(c).alias(c) for c in NUMBERS])


@query(
    "minmax_scale",
    with_txn(
        "SELECT trans_num, " + ", ".join(
            s6(f"greatest(0::DOUBLE, least(1::DOUBLE, ({c} - lo_{c}) / (hi_{c} - lo_{c})))") + f" AS {c}" for c in ("amt", "city_pop")
        ) + " FROM txn, ends",
        "ends AS (SELECT min(amt) lo_amt, max(amt) hi_amt, min(city_pop)::DOUBLE lo_city_pop, max(city_pop)::DOUBLE hi_city_pop FROM txn WHERE is_fraud = 0)",
    ),
)
def _minmax_scale(spark, sf_dir):
    """Fitted on the normal rows; values beyond their range are clipped."""
    df = transactions(spark, sf_dir)
    ends = P.fit_minmax(df.where("is_fraud = 0"), ["amt", "city_pop"])
    return df.select("trans_num", *[r6(P.minmax(F.col(c), *e, clip=True)).alias(c) for c, e in ends.items()])


def _preprocess_sql(part: bool = False) -> str:
    cells = [f"{s6(_robust(c, 'train'))} AS {c}" for c in NUMBERS]
    cells += [f"{_code(c, 'train')}::DOUBLE AS {c}" for c in P.CODED]
    return with_txn(
        f"SELECT trans_num, is_fraud, {', '.join(cells)}, {_one_hot_sql('t')}{', split' if part else ''} FROM aged_parts t",
        PARTS,
        f"aged_parts AS (SELECT *, {AGE} age FROM parts)",
        "train AS (SELECT * FROM aged_parts WHERE split = 'train')",
    )


def _rounded(df):
    shown = [c for c in df.columns if c not in ("trans_num", "is_fraud")]
    return df.select("trans_num", "is_fraud", *[r6(c).alias(c) for c in shown])


def _three(parts):
    """The rounded parts as one table."""
    named = [_rounded(p).withColumn("split", F.lit(n)) for p, n in zip(parts, ("train", "val", "test"), strict=True)]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("preprocess", _preprocess_sql())
def _preprocess(spark, sf_dir):
    df = transactions(spark, sf_dir)
    train, _, _ = SP.TimeSplit.fit(df).parts(df)
    return _rounded(P.Preprocessor.fit(train).transform(df))


@query("split_and_preprocess", _preprocess_sql(part=True))
def _split_and_preprocess(spark, sf_dir):
    *parts, _ = P.split_and_preprocess(transactions(spark, sf_dir))
    return _three(parts)


@query("concat_columns", with_txn(f"SELECT trans_num, {s6('amt')} AS amt, {_code('state', 'txn')}::BIGINT AS state, {_one_hot_sql('t')} FROM txn t"))
def _concat_columns(spark, sf_dir):
    """Numbers, codes and indicators side by side, by one projection instead of a positional concatenation."""
    df = transactions(spark, sf_dir)
    cells = P.indicators(df, P.indicator_levels(df, P.INDICATED))
    codes = materialise(P.ordinal_codes(df, ["state"]))
    wide = P.apply_codes(df.withColumns(cells), codes, ["state"])
    return wide.select("trans_num", r6("amt").alias("amt"), F.col("state").cast("long").alias("state"), *cells)


@query("state_load", _preprocess_sql(part=True))
def _state_load(spark, sf_dir):
    """Fit, save, load, apply."""
    from cardsentry.sources.state import load_preprocessor, save_preprocessor

    df = transactions(spark, sf_dir)
    parts = SP.TimeSplit.fit(df).parts(df)
    path = scratch_path(spark, "preprocessor")
    save_preprocessor(P.Preprocessor.fit(parts[0]), spark, path)
    model = load_preprocessor(spark, path)
    return _three([model.transform(p) for p in parts])
