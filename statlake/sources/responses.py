"""Readers for landed API response pages.

A landed page is one JSON response body per file.  Files are read with
``wholetext`` so one file is one row (one task per page; more pages, not
bigger pages, give parallelism).  Each body is parsed once into an envelope
struct whose nested nodes stay JSON text; list nodes are then normalised with
the *wrap idiom* and exploded.  Everything is a built-in expression, so the
parse runs inside whole-stage codegen with no Python on the row path.

JSON shape rules kept from the source service:

* a list node may be a single object or an array -> always an array;
* an absent node gives no rows (never a phantom null row);
* leading ``@`` is stripped from keys and ``$`` is the node's text value;
* numbers arrive as strings (``5`` -> ``"5"``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statlake.functions.values import as_count
from statlake.model import AXES

RECORD = "map<string,string>"
# VALUE records parse straight into a struct of the known keys (no per-record
# hash map).  Only pages that name another key are parsed to maps as well, and
# their further keys are kept in ``extra``.
VALUE_RECORD = "struct<" + ",".join(f"`@{a}`:string" for a in [*AXES, "unit"]) + ",`$`:string>"

_VALUE_KEYS = [*(f"@{a}" for a in [*AXES, "unit"]), "$"]
UNKNOWN_VALUE_KEY = r'"(?!(?:' + "|".join(k.replace("$", r"\$") for k in _VALUE_KEYS) + r')")[^"\\]*"\s*:'
CLASS_KEYS = ["@code", "@name", "@level", "@unit", "@parentCode"]

# Envelope of a data page.  Nested list nodes are kept as JSON text.
DATA_ENVELOPE = (
    "struct<GET_STATS_DATA:struct<"
    "RESULT:struct<STATUS:string,ERROR_MSG:string>,"
    "PARAMETER:struct<LANG:string,STATS_DATA_ID:string>,"
    "STATISTICAL_DATA:struct<"
    "RESULT_INF:struct<TOTAL_NUMBER:string,FROM_NUMBER:string,TO_NUMBER:string,NEXT_KEY:string>,"
    "TABLE_INF:struct<`@id`:string>,"
    "CLASS_INF:struct<CLASS_OBJ:string>,"
    "DATA_INF:struct<NOTE:string,VALUE:string>>>>"
)

# The same envelope without the VALUE records: page counters, code lists
# and notes never materialise the (up to 100k-record) VALUE array; the JSON
# parser skips it.
DATA_META_ENVELOPE = (
    "struct<GET_STATS_DATA:struct<"
    "RESULT:struct<STATUS:string,ERROR_MSG:string>,"
    "PARAMETER:struct<LANG:string,STATS_DATA_ID:string>,"
    "STATISTICAL_DATA:struct<"
    "RESULT_INF:struct<TOTAL_NUMBER:string,FROM_NUMBER:string,TO_NUMBER:string,NEXT_KEY:string>,"
    "TABLE_INF:struct<`@id`:string>,"
    "CLASS_INF:struct<CLASS_OBJ:string>,"
    "DATA_INF:struct<NOTE:string>>>>"
)

META_ENVELOPE = (
    "struct<GET_META_INFO:struct<"
    "RESULT:struct<STATUS:string,ERROR_MSG:string>,"
    "PARAMETER:struct<LANG:string,STATS_DATA_ID:string>,"
    "METADATA_INF:struct<TABLE_INF:string,CLASS_INF:struct<CLASS_OBJ:string>>>>"
)

LIST_ENVELOPE = (
    "struct<GET_STATS_LIST:struct<RESULT:struct<STATUS:string,ERROR_MSG:string>,"
    "DATALIST_INF:struct<NUMBER:string,TABLE_INF:string>>>"
)

CATALOG_ENVELOPE = (
    "struct<GET_DATA_CATALOG:struct<RESULT:struct<STATUS:string,ERROR_MSG:string>,"
    "DATA_CATALOG_LIST_INF:struct<DATA_CATALOG_INF:string>>>"
)

ENVELOPE_ROOT = {
    "data": "GET_STATS_DATA",
    "data_meta": "GET_STATS_DATA",
    "meta": "GET_META_INFO",
    "list": "GET_STATS_LIST",
    "catalog": "GET_DATA_CATALOG",
}


# ---------------------------------------------------------------------------
# Scans
# ---------------------------------------------------------------------------

def read_bodies(spark: SparkSession, path: str | list[str],
                partitions: list[str] | None = None) -> DataFrame:
    """Landed response files -> ``(body, source_path, <partition columns>)``.

    One file is one body (whole-text read, so pretty-printed JSON works).
    Hive-style folders such as ``stats_data_id=.../lang=E/`` become columns
    through partition discovery; name them in ``partitions`` to keep them as
    strings (codes like ``0009900001`` keep their leading zeros) and to let
    filters on them prune folders.
    """
    reader = spark.read
    if partitions:
        reader = reader.schema("value string, " + ", ".join(f"`{p}` string" for p in partitions))
    df = reader.text(path, wholetext=True)
    return df.select(
        F.col("value").alias("body"),
        F.col("_metadata.file_path").alias("source_path"),
        *[c for c in df.columns if c != "value"],
    )


# ---------------------------------------------------------------------------
# Shape helpers
# ---------------------------------------------------------------------------

def wrap_records(node: Column, schema: str = RECORD) -> Column:
    """Normalise a JSON list node that may be one object or an array of
    objects into an array; an absent node gives null (explode -> no rows)."""
    as_array = F.from_json(node, f"array<{schema}>")
    as_object = F.from_json(node, schema)
    return F.when(
        node.isNotNull(),
        F.coalesce(as_array, F.when(as_object.isNotNull(), F.array(as_object))),
    )


def wrap_texts(node: Column) -> Column:
    """Like ``wrap_records`` but keeps each record as JSON text."""
    as_array = F.from_json(node, "array<string>")
    return F.when(
        node.isNotNull(),
        F.coalesce(as_array, F.when(F.ltrim(node).startswith("{"), F.array(node))),
    )


def is_json_array(node: Column) -> Column:
    """True when a JSON text node is a non-empty array."""
    v = F.try_parse_json(node)
    return F.schema_of_variant(v).startswith("ARRAY") & (F.length(F.trim(node)) > 2)


def parse_envelope(bodies: DataFrame, kind: str = "data", body_col: str = "body") -> DataFrame:
    """Parse the body once into ``_env`` (struct) next to the input columns.

    The envelope is emitted by a generator (``explode`` of a one-element
    array): filters on ``_env`` (status, table id, language) then stay above
    it instead of being pushed down with ``from_json`` inlined into them,
    which would parse every body a second time.
    """
    schema = {
        "data": DATA_ENVELOPE,
        "data_meta": DATA_META_ENVELOPE,
        "meta": META_ENVELOPE,
        "list": LIST_ENVELOPE,
        "catalog": CATALOG_ENVELOPE,
    }[kind]
    env = F.from_json(F.col(body_col), schema)[ENVELOPE_ROOT[kind]]
    return bodies.select("*", F.explode(F.array(env)).alias("_env"))


def _identity(env: DataFrame, cols: dict[str, Column]) -> dict[str, Column]:
    """Page identity: caller-supplied columns win over what the body says."""
    out = {}
    for name, fallback in cols.items():
        out[name] = F.coalesce(F.col(name), fallback) if name in env.columns else fallback
    return out


def _data_identity(env: DataFrame) -> dict[str, Column]:
    ids = _identity(
        env,
        {
            "stats_data_id": F.coalesce(
                F.col("_env.PARAMETER.STATS_DATA_ID"),
                F.col("_env.STATISTICAL_DATA.TABLE_INF.`@id`"),
            ),
            "lang": F.upper(F.col("_env.PARAMETER.LANG")),
        },
    )
    fp = F.col("query_fingerprint") if "query_fingerprint" in env.columns else F.lit(None).cast("string")
    ids["query_fingerprint"] = F.coalesce(fp, ids["stats_data_id"])
    return ids


# ---------------------------------------------------------------------------
# Data pages
# ---------------------------------------------------------------------------

def page_info(bodies: DataFrame, body_col: str = "body", keep: list[str] | None = None) -> DataFrame:
    """One row per data page: identity, status and the paging counters (and
    the input's columns ``keep``)."""
    env = parse_envelope(bodies, "data_meta", body_col)
    inf = F.col("_env.STATISTICAL_DATA.RESULT_INF")
    return env.select(
        *[c.alias(n) for n, c in _data_identity(env).items()],
        as_count(inf["FROM_NUMBER"]).alias("page_offset"),
        F.col("_env.RESULT.STATUS").alias("status_raw"),
        F.col("_env.RESULT.ERROR_MSG").alias("error_msg"),
        as_count(inf["TOTAL_NUMBER"]).alias("total_number"),
        as_count(inf["FROM_NUMBER"]).alias("from_number"),
        as_count(inf["TO_NUMBER"]).alias("to_number"),
        as_count(inf["NEXT_KEY"]).alias("next_key"),
        *(keep or []),
    )


PAGE_KEY = ["stats_data_id", "lang", "query_fingerprint", "page_offset"]


def parsed_pages(bodies: DataFrame, body_col: str = "body") -> DataFrame:
    """One row per body, parsed once: identity, classified status (``ok``,
    ``error_class``, redacted ``error_msg``), paging counters and the JSON text
    of the list nodes ``class_obj``, ``note_node`` and ``value_node``.

    ``keyed`` tells that the page can be landed (ok, a table id and a position),
    ``page`` is its identity: the page key or, for other pages, a digest of the
    body; ``body`` is kept for those only."""
    from statlake.operators.quality import classify_status

    env = parse_envelope(bodies, "data", body_col)
    data, inf = F.col("_env.STATISTICAL_DATA"), F.col("_env.STATISTICAL_DATA.RESULT_INF")
    pages = classify_status(env.select(
        *[c.alias(n) for n, c in _data_identity(env).items()],
        as_count(inf["FROM_NUMBER"]).alias("page_offset"),
        F.col("_env.RESULT.STATUS").alias("status_raw"), F.col("_env.RESULT.ERROR_MSG").alias("error_msg"),
        as_count(inf["TOTAL_NUMBER"]).alias("total_number"), as_count(inf["FROM_NUMBER"]).alias("from_number"),
        as_count(inf["TO_NUMBER"]).alias("to_number"), as_count(inf["NEXT_KEY"]).alias("next_key"),
        data["CLASS_INF"]["CLASS_OBJ"].alias("class_obj"), data["DATA_INF"]["NOTE"].alias("note_node"),
        data["DATA_INF"]["VALUE"].alias("value_node"), F.col(body_col).alias("body")))
    keyed = F.col("ok") & F.col("stats_data_id").isNotNull() & F.col("page_offset").isNotNull()
    digest = F.sha2(F.col("body").cast("binary"), 256)
    return pages.withColumns({
        "keyed": keyed,
        "page": F.when(keyed, F.to_json(F.struct(*PAGE_KEY))).otherwise(F.concat(F.lit("body "), F.coalesce(digest, F.lit("null")))),
        "body": F.when(~keyed, F.col("body"))})


def left_out(pages: DataFrame) -> DataFrame:
    """What ``parsed_pages`` cannot land, with the reason."""
    reason = F.when(F.col("ok"), F.lit("no_page_key")).otherwise(F.coalesce("error_class", F.lit("parse_error")))
    return pages.where(~F.col("keyed")).select(
        F.sha2(F.col("body").cast("binary"), 256).alias("body_sha256"), reason.alias("reason"), "error_msg", "body",
        "stats_data_id", "lang", "query_fingerprint", "page_offset", "status_raw", "status", "error_class")


def page_values(pages: DataFrame) -> DataFrame:
    """VALUE records of parsed pages -> one coded observation per row."""
    node = F.col("value_node")
    # below the explode: once a page, not once a record
    more = F.when(F.rlike(node, F.lit(UNKNOWN_VALUE_KEY)), wrap_records(node))
    exploded = pages.select(*PAGE_KEY, "value_node", more.alias("more")).select(
        *PAGE_KEY, "more", F.posexplode(wrap_records(node, VALUE_RECORD)).alias("pos", "r"))
    r = F.col("r")
    extra = F.map_filter(F.get("more", F.col("pos")), lambda k, v: ~k.isin(*_VALUE_KEYS))
    extra = F.transform_keys(extra, lambda k, v: F.ltrim(k, F.lit("@")))
    return exploded.select(
        *PAGE_KEY, "pos",
        *[r[f"@{a}"].alias(a) for a in AXES],
        r["@unit"].alias("unit"),
        r["$"].alias("value"),
        F.when(F.size(extra) > 0, extra).alias("extra"),
    )


def value_rows(bodies: DataFrame, body_col: str = "body", ok_only: bool = True) -> DataFrame:
    """VALUE records of data pages -> one coded observation per row.

    ``page_offset`` is the page's absolute 1-based start (FROM_NUMBER) and
    ``pos`` the 0-based index within the page, so ``page_offset + pos`` is
    the absolute row number without any window.  Pages whose status is not
    0 yield no rows here; they are reported by ``quality.classify_status``.
    """
    env = parse_envelope(bodies, "data", body_col)
    if ok_only:
        env = env.where(F.col("_env.RESULT.STATUS").try_cast("int") == 0)
    return page_values(env.select(
        *[c.alias(n) for n, c in _data_identity(env).items()],
        as_count(F.col("_env.STATISTICAL_DATA.RESULT_INF.FROM_NUMBER")).alias("page_offset"),
        F.col("_env.STATISTICAL_DATA.DATA_INF.VALUE").alias("value_node")))


def _class_rows(env: DataFrame, class_obj: Column, ids: dict[str, Column]) -> DataFrame:
    axes = env.select(
        *[c.alias(n) for n, c in ids.items()],
        F.posexplode(wrap_records(class_obj)).alias("axis_idx", "o"),
    )
    codes = axes.select(
        *ids.keys(),
        F.col("o")["@id"].alias("axis"),
        F.col("o")["@name"].alias("axis_name"),
        (F.col("axis_idx") + 1).cast("int").alias("axis_pos"),
        F.explode(wrap_records(F.col("o")["CLASS"])).alias("c"),
    )
    c = F.col("c")
    more = F.transform_keys(F.map_filter(c, lambda k, v: ~k.isin(*CLASS_KEYS)), lambda k, v: F.ltrim(k, F.lit("@")))
    return codes.select(
        *ids.keys(), "axis", "axis_name", "axis_pos",
        c["@code"].alias("code"),
        c["@name"].alias("name"),
        c["@level"].alias("level"),
        c["@unit"].alias("unit"),
        c["@parentCode"].alias("parent"),
        F.when(F.size(more) > 0, F.to_json(F.map_from_entries(F.array_sort(F.map_entries(more))))).alias("extra"),
    )


def _class_objects(bodies: DataFrame, body_col: str) -> DataFrame:
    """The distinct code-list nodes of all ok pages of each table."""
    env = parse_envelope(bodies, "data_meta", body_col)
    env = env.where(F.col("_env.RESULT.STATUS").try_cast("int") == 0)
    ids = _data_identity(env)
    return env.select(
        ids["stats_data_id"].alias("stats_data_id"),
        ids["lang"].alias("lang"),
        F.col("_env.STATISTICAL_DATA.CLASS_INF.CLASS_OBJ").alias("class_obj"),
    ).where(F.col("class_obj").isNotNull()).distinct()


def class_rows(bodies: DataFrame, body_col: str = "body") -> DataFrame:
    """Code lists bundled in data pages -> long ``classes`` table.

    The distinct union over all pages of a table: pages (and pulls with
    different filters) that repeat the same lists are parsed once, pages that
    carry only the codes they use add theirs.  ``extra`` holds further keys of
    an entry as JSON."""
    return _classes_of(_class_objects(bodies, body_col))


def _classes_of(objects: DataFrame) -> DataFrame:
    return _class_rows(objects, F.col("class_obj"), {k: F.col(k) for k in ("stats_data_id", "lang")}).distinct()


def page_classes(pages: DataFrame) -> DataFrame:
    """Code lists of parsed pages; equal lists are parsed once."""
    return _classes_of(pages.select("stats_data_id", "lang", "class_obj").where("class_obj is not null").distinct())


def axis_rows(bodies: DataFrame, body_col: str = "body") -> DataFrame:
    """Axes that the pages name, also those with an empty code list."""
    objects = _class_objects(bodies, body_col)
    axes = objects.select("stats_data_id", "lang", F.posexplode(wrap_records(F.col("class_obj"))).alias("i", "o"))
    return axes.select("stats_data_id", "lang", F.col("o")["@id"].alias("axis"), F.col("o")["@name"].alias("axis_name"),
                       (F.col("i") + 1).cast("int").alias("axis_pos")).distinct()


def meta_class_rows(bodies: DataFrame, body_col: str = "body") -> DataFrame:
    """Code lists of metadata responses (same parser, another JSON root)."""
    env = parse_envelope(bodies, "meta", body_col)
    env = env.where(F.col("_env.RESULT.STATUS").try_cast("int") == 0)
    ids = _identity(
        env,
        {
            "stats_data_id": F.col("_env.PARAMETER.STATS_DATA_ID"),
            "lang": F.upper(F.col("_env.PARAMETER.LANG")),
        },
    )
    return _class_rows(env, F.col("_env.METADATA_INF.CLASS_INF.CLASS_OBJ"), ids)


def meta_table_info(bodies: DataFrame, body_col: str = "body") -> DataFrame:
    """``TABLE_INF`` of metadata responses as JSON text (flatten with
    ``sources.flatten.flatten_json``)."""
    env = parse_envelope(bodies, "meta", body_col)
    return env.select(
        F.col("_env.PARAMETER.STATS_DATA_ID").alias("stats_data_id"),
        F.upper(F.col("_env.PARAMETER.LANG")).alias("lang"),
        F.col("_env.METADATA_INF.TABLE_INF").alias("table_inf"),
    )


def note_rows(bodies: DataFrame, body_col: str = "body") -> DataFrame:
    """The annotation legend (``NOTE``: marker char -> meaning), the distinct
    union over all pages of a table."""
    env = parse_envelope(bodies, "data_meta", body_col)
    env = env.where(F.col("_env.RESULT.STATUS").try_cast("int") == 0)
    ids = _data_identity(env)
    nodes = env.select(
        ids["stats_data_id"].alias("stats_data_id"),
        ids["lang"].alias("lang"),
        F.col("_env.STATISTICAL_DATA.DATA_INF.NOTE").alias("note_node"),
    )
    return page_notes(nodes)


def page_notes(pages: DataFrame) -> DataFrame:
    """Annotation legends of parsed pages; equal ones are parsed once."""
    nodes = pages.select("stats_data_id", "lang", "note_node").where("note_node is not null").distinct()
    rows = nodes.select("stats_data_id", "lang", F.explode(wrap_records(F.col("note_node"))).alias("n"))
    return rows.select(
        "stats_data_id", "lang", F.col("n")["@char"].alias("char"), F.col("n")["$"].alias("note")
    ).distinct()


def failed_pages(bodies: DataFrame, body_col: str = "body") -> DataFrame:
    """Quarantine: the pages that the readers above skip, with the reason
    (not JSON, no status, or an error class), next to their other columns."""
    from statlake.operators.quality import response_status

    status = response_status(bodies, body_col=body_col)
    return status.where(~F.col("ok"))


# ---------------------------------------------------------------------------
# Catalogue responses
# ---------------------------------------------------------------------------

def catalog_records(bodies: DataFrame, kind: str = "list", body_col: str = "body") -> DataFrame:
    """Catalogue listings -> one JSON record per entry (``record`` text) with a
    ``row_id`` of its page and position: the page's ``source_path`` or
    ``page_no`` where it has one, else a digest of its body.  Flatten with
    ``sources.flatten``."""
    env = parse_envelope(bodies, kind, body_col)
    env = env.where(F.col("_env.RESULT.STATUS").try_cast("int") == 0)
    node = (
        F.col("_env.DATALIST_INF.TABLE_INF")
        if kind == "list"
        else F.col("_env.DATA_CATALOG_LIST_INF.DATA_CATALOG_INF")
    )
    named = [c for c in ("source_path", "page_no") if c in env.columns]
    page = F.col(named[0]).cast("string") if named else F.sha2(F.col(body_col).cast("binary"), 256)
    rows = env.select(page.alias("page"), F.posexplode(wrap_texts(node)).alias("pos", "record"))
    return rows.select(F.concat_ws(":", "page", F.col("pos").cast("string")).alias("row_id"), "record")
