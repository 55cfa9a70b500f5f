"""JSON request payloads as a table source.

Two payload shapes are accepted, as in the scoring API:
* named samples: ``{"samples": [{"loc": 1.0, "v(g)": 2.0 | "v_g": 2.0, ...}, ...]}``
* positional rows: ``{"inputs": [[21 numbers], ...]}``
Both become one row per sample via ``posexplode``; names are aligned to the
model order with missing features → 0.0 (P6) and widths are checked (P7).

``request_rows`` and ``refused_requests`` read a stream of both shapes as VARIANT, each
payload by what it holds; together they keep every request. The other
functions read one shape, named by ``kind``, with a fixed schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.functions import sqltext as Q
from tabspark.schema import ALIASES, FEATURES, col

SAMPLES_SCHEMA = T.StructType([T.StructField("samples", T.ArrayType(T.MapType(T.StringType(), T.DoubleType())))])
#: Ids once more as integers: above 2 ** 53 a double is not exact.
IDS_SCHEMA = "samples array<struct<id: bigint>>"
INPUTS_SCHEMA = T.StructType([T.StructField("inputs", T.ArrayType(T.ArrayType(T.DoubleType())))])


def _named(m: str, name: str) -> str:
    """SQL: the value under ``name`` (or its alias) in map ``m``, 0.0 when absent."""
    alias = {v: k for k, v in ALIASES.items()}.get(name)
    vals = [f"element_at({m}, {Q.str_lit(name)})"]
    if alias:
        vals.append(f"element_at({m}, {Q.str_lit(alias)})")
    return "coalesce(" + ", ".join(vals) + ", 0.0D)"


def rejection(payload: str, kind: str = "samples", features=FEATURES):
    """Column: why a payload is not scored, else null: ``malformed`` (null, no JSON, or not of the
    shape of ``kind``), ``empty`` (no sample) or ``width`` (an input without one value per feature)."""
    schema = SAMPLES_SCHEMA if kind == "samples" else INPUTS_SCHEMA
    got = F.from_json(F.col(payload), schema)[kind]
    bad = F.exists(got, lambda x: x.isNull())
    out = F.when(got.isNull(), "malformed").when(F.size(got) == 0, "empty")
    if kind == "samples":
        return out.when(bad, "malformed")
    full = F.forall(got, lambda x: x.isNotNull() & (F.size(x) == len(features)) & ~F.exists(x, lambda v: v.isNull()))
    return out.when(~full, "width")


def accepted_requests(df: DataFrame, payload: str, kind: str = "samples") -> DataFrame:
    """The requests that are scored, whole; with ``rejected_requests``, every request."""
    return df.where(rejection(payload, kind).isNull())


def rejected_requests(df: DataFrame, payload: str, kind: str = "samples") -> DataFrame:
    """The other requests as they came, with their ``reason``."""
    return df.withColumn("reason", rejection(payload, kind)).where("reason IS NOT NULL")


def samples_to_features(df: DataFrame, payload: str, keep: list[str] | None = None,
                        features=FEATURES) -> DataFrame:
    """Named-sample payloads → one row per sample (request columns kept). ``sample_id`` is exact where the
    payload writes it as an integer."""
    keep = keep or []
    parsed = df.select(*[col(k) for k in keep], F.from_json(F.col(payload), SAMPLES_SCHEMA).alias("__p"),
                       F.from_json(F.col(payload), IDS_SCHEMA)["samples"]["id"].alias("__ids"))
    ex = parsed.select(*[col(k) for k in keep], "__ids", F.posexplode(F.col("__p.samples")).alias("pos", "__m"))
    return ex.selectExpr(*[Q.ident(k) for k in keep], "pos",
                         *[f"{_named('__m', f)} AS {Q.ident(f)}" for f in features],
                         "coalesce(try_element_at(__ids, pos + 1), CAST(element_at(__m, 'id') AS BIGINT)) AS sample_id")


def inputs_to_features(df: DataFrame, payload: str, keep: list[str] | None = None,
                       features=FEATURES) -> DataFrame:
    """Positional payloads → one row per input vector, with ``width_ok``."""
    keep = keep or []
    parsed = df.select(*[col(k) for k in keep], F.from_json(F.col(payload), INPUTS_SCHEMA).alias("__p"))
    ex = parsed.select(*[col(k) for k in keep], F.posexplode(F.col("__p.inputs")).alias("pos", "__a"))
    w = len(features)
    return ex.selectExpr(*[Q.ident(k) for k in keep], "pos",
                         *[f"coalesce(try_element_at(__a, {i + 1}), 0.0D) AS {Q.ident(f)}"
                           for i, f in enumerate(features)],
                         f"(size(__a) = {w}) AS width_ok")


def features_to_samples(df: DataFrame, request_key, features=FEATURES, id_col: str = "id",
                        use_aliases: bool = True) -> DataFrame:
    """Builds named-sample payloads from feature rows, grouped by ``request_key``
    (a bounded number of rows per request)."""
    rev = {v: k for k, v in ALIASES.items()} if use_aliases else {}
    pairs = [f"'id', {Q.ident(id_col)}"] + [f"{Q.str_lit(rev.get(f, f))}, {Q.as_double(f)}" for f in features]
    sample = F.expr("named_struct(" + ", ".join(pairs) + ")")
    return (df.groupBy(request_key.alias("request_id"))
            .agg(F.to_json(F.struct(F.collect_list(sample).alias("samples"))).alias("payload")))


def features_to_inputs(df: DataFrame, request_key, features=FEATURES, id_col: str = "id") -> DataFrame:
    arr = F.expr("array(" + ", ".join(Q.as_double(f) for f in features) + ")")
    return (df.groupBy(request_key.alias("request_id"))
            .agg(F.to_json(F.struct(F.transform(F.array_sort(F.collect_list(F.struct(col(id_col).alias("k"), arr.alias("a")))),
                                                lambda s: s["a"]).alias("inputs"))).alias("payload")))


# ------------------------------------------------------------------ both shapes as VARIANT
def _path(name: str) -> str:
    return Q.str_lit(f'$["{name}"]')


def _named_value(item: str, name: str) -> tuple[str, str]:
    """SQL: the value under ``name`` or its alias in a variant (0.0 when absent or null), and whether
    there is one of a type that is no number."""
    alias = {v: k for k, v in ALIASES.items()}.get(name)
    paths = [_path(n) for n in (name, alias) if n]
    value = "coalesce(" + ", ".join(f"try_variant_get({item}, {p}, 'double')" for p in paths) + ", 0.0D)"
    stray = " OR ".join(f"(variant_get({item}, {p}, 'variant') IS NOT NULL AND NOT is_variant_null(variant_get({item}, {p}, 'variant')) "
                        f"AND try_variant_get({item}, {p}, 'double') IS NULL)" for p in paths)
    return value, f"({stray})"


def _read_requests(df: DataFrame, payload: str, features) -> DataFrame:
    """``df`` plus ``__reason`` (null: scored) and ``__samples``: (sample_id, values) of each sample.

    A number may be written as a string, as in the scoring API; other strings, objects and lists are of the wrong
    type. Reasons, the first that holds: ``malformed`` (null, no JSON, neither shape or both, or a sample that is no
    object or list), ``empty`` (no sample), ``width`` (a list without one value per feature), ``type``."""
    named = [_named_value("x", f) for f in features]
    one = (f"CASE WHEN __named THEN named_struct('id', try_variant_get(x, '$.id', 'bigint'), 'values', array({', '.join(v for v, _ in named)}), "
           f"'shape', try_variant_get(x, '$', 'map<string,variant>') IS NOT NULL, 'width', true, 'type', NOT ({' OR '.join(s for _, s in named)})) "
           "ELSE transform(array(try_variant_get(x, '$', 'array<variant>')), a -> named_struct('id', CAST(NULL AS BIGINT), "
           "'values', transform(a, e -> try_variant_get(e, '$', 'double')), 'shape', a IS NOT NULL, "
           f"'width', size(a) = {len(features)}, 'type', forall(a, e -> try_variant_get(e, '$', 'double') IS NOT NULL)))[0] END")
    d = df.withColumn("__v", F.try_parse_json(F.col(payload)))
    d = d.withColumn("__s", F.expr("try_variant_get(__v, '$.samples', 'array<variant>')")).withColumn(
        "__i", F.expr("try_variant_get(__v, '$.inputs', 'array<variant>')"))
    d = d.withColumn("__named", F.expr("__s IS NOT NULL")).withColumn("__samples", F.expr(f"transform(coalesce(__s, __i), x -> {one})"))
    reason = ("CASE WHEN (__s IS NULL) = (__i IS NULL) OR exists(__samples, x -> NOT x.shape) THEN 'malformed' "
              "WHEN size(__samples) = 0 THEN 'empty' WHEN exists(__samples, x -> NOT x.width) THEN 'width' "
              "WHEN exists(__samples, x -> NOT x.type) THEN 'type' END")
    return d.withColumn("__reason", F.expr(reason)).drop("__v", "__s", "__i", "__named")


def request_rows(df: DataFrame, payload: str, keep: list[str] | None = None, features=FEATURES) -> DataFrame:
    """One row per sample of the requests that are scored, of either shape: ``keep``, ``pos``, features, ``sample_id``."""
    keep = keep or []
    d = _read_requests(df, payload, features).where("__reason IS NULL")
    d = d.select(*[col(k) for k in keep], F.posexplode("__samples").alias("pos", "__x"))
    return d.selectExpr(*[Q.ident(k) for k in keep], "pos", *[f"__x.values[{i}] AS {Q.ident(f)}" for i, f in enumerate(features)],
                        "__x.id AS sample_id")


def refused_requests(df: DataFrame, payload: str, features=FEATURES) -> DataFrame:
    """The requests that ``request_rows`` leaves out, as they came, with their ``reason``."""
    d = _read_requests(df, payload, features).where("__reason IS NOT NULL")
    return d.drop("__samples").withColumnRenamed("__reason", "reason")
