"""Flatteners for paged and encoded JSON payloads.

Each payload is one row (read with ``spark.read.schema(...).json`` from the
landed files, one page per line); the flatteners are explode/select/higher-
order-function plans, so pages are decoded in parallel and never pass
through the driver. Where order matters (delta rows, "first" values) the
position inside the page is carried as an explicit ordinal.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _fail(msg: str):
    return F.raise_error(F.lit(msg))


def flatten_feature_pages(pages: DataFrame, features: str = "features",
                          keep: Sequence[str] = ()) -> DataFrame:
    """``{features: [{attributes: {...}}]}`` pages -> one row per feature."""
    f = pages.select(*keep, F.explode(features).alias("__f"))
    return f.select(*keep, "__f.attributes.*")


def flatten_record_pages(pages: DataFrame, page_id: str = "page") -> DataFrame:
    """``{success, result: {total, records: [...]}}`` pages -> records.

    A page whose ``success`` is false or missing fails the job; so does a record
    count that differs from the advertised total, or a missing total (incomplete
    download).
    """
    checked = pages.filter(F.when(~F.coalesce(F.col("success"), F.lit(False)), _fail("record page reported no success"))
                           .otherwise(F.lit(True)))
    # one scalar subquery (a single extra scan) for the advertised total and
    # the number of records actually delivered
    counts = checked.select(F.struct(F.max("result.total").alias("total"),
                                     F.count_if(F.col("result.total").isNull()).alias("untold"),
                                     F.sum(F.coalesce(F.array_size("result.records"), F.lit(0))).alias("got"))).scalar()
    checked = checked.filter(F.when((counts["untold"] > 0) | (counts["total"] != counts["got"]),
                                    _fail("record pages incomplete: total != records"))
                             .otherwise(F.lit(True)))
    return checked.select(F.explode("result.records").alias("__r")).select("__r.*")


def flatten_keyed_array(pages: DataFrame, key: str = "data") -> DataFrame:
    """``{"data": [...]}`` -> rows; a payload without the key fails."""
    checked = pages.filter(F.when(F.col(key).isNull(), _fail(f"payload lacks key {key!r}"))
                           .otherwise(F.lit(True)))
    return checked.select(F.explode(key).alias("__r")).select("__r.*")


def flatten_positional_records(pages: DataFrame, names: Sequence[str], array: str = "C",
                               rows: str = "rows", types: Mapping[str, str] | None = None,
                               strip_suffix: Mapping[str, str] | None = None,
                               keep: Sequence[str] = ()) -> DataFrame:
    """``[{"C": [a, b, "0.71D"]}, ...]`` -> named columns; a suffix (``D``)
    is stripped before the cast."""
    types = types or {}
    strip_suffix = strip_suffix or {}
    r = pages.select(*keep, F.explode(rows).alias("__r"))
    cols = []
    for i, n in enumerate(names):
        v = F.element_at(F.col(f"__r.{array}"), i + 1)
        if n in strip_suffix:
            v = F.regexp_replace(v, F.lit(strip_suffix[n] + "$"), F.lit(""))
        if n in types:
            v = v.cast(types[n])
        cols.append(v.alias(n))
    return r.select(*keep, *cols)


def decode_dictionary_columns(payloads: DataFrame, payload_id: str = "payload",
                              columns: str = "columns", data: str = "dataColumns",
                              fill=0) -> DataFrame:
    """Dictionary-encoded columns -> long values.

    Each column spec is ``{fieldCaption, dataType, valueIndices[],
    aliasIndices[]}``; the dictionaries are ``{dataType, dataValues[]}``.
    A value index reads ``dict[dtype][abs(i)]``; an alias index reads
    ``dict[dtype][i]`` when ``i >= 0`` else ``cstring[abs(i) - 1]``. The
    lookup is an in-row map access (no join). Output: one row per
    (payload, position) with ``<caption>-value`` / ``<caption>-alias``
    columns; ragged columns are padded with ``fill``.
    """
    dicts = F.map_from_entries(F.transform(F.col(data), lambda d: F.struct(d["dataType"], d["dataValues"])))
    spec = payloads.select(payload_id, dicts.alias("__d"), F.explode(columns).alias("__c"))
    vals = F.transform(F.col("__c.valueIndices"),
                       lambda i: F.element_at(F.element_at(F.col("__d"), F.col("__c.dataType")), F.abs(i) + 1))
    cstr = F.element_at(F.col("__d"), F.lit("cstring"))
    alias = F.transform(F.col("__c.aliasIndices"), lambda i: F.when(
        i >= 0, F.element_at(F.element_at(F.col("__d"), F.col("__c.dataType")), i + 1))
        .otherwise(F.element_at(cstr, F.abs(i))))
    both = spec.select(payload_id, F.col("__c.fieldCaption").alias("caption"),
                       vals.alias("v"), alias.alias("a"))
    long_v = both.select(payload_id, F.concat("caption", F.lit("-value")).alias("name"),
                         F.posexplode("v").alias("pos", "text"))
    long_a = both.select(payload_id, F.concat("caption", F.lit("-alias")).alias("name"),
                         F.posexplode("a").alias("pos", "text"))
    return long_v.unionByName(long_a)


def single_pane_metrics(panes: DataFrame, names: Sequence[str], payload_id: str = "payload",
                        label: str = "name", data: str = "dataColumns") -> DataFrame:
    """One value per pane of a dashboard payload -> one row per payload.

    A pane row has ``dtype`` and ``idx``, and the payload's dictionaries
    (``{dataType, dataValues[]}``: integers first, reals second, texts third). An
    ``integer`` pane reads the first dictionary, a ``real`` pane the second; a pane
    of another type, without type or without index is skipped. The last text of
    the third dictionary is the payload's ``Last update``. The first value of a
    repeated name wins, by the pane's ``ordinal``."""
    values = lambda i: F.get(F.col(data), F.lit(i))["dataValues"]
    at = F.col("idx")
    value = F.when(F.col("dtype") == "integer", F.get(values(0), at)).when(F.col("dtype") == "real", F.get(values(1), at))
    known = F.col("dtype").isin("integer", "real") & at.isNotNull()
    agg = [F.min_by(F.when(known & (F.col(label) == n), value), F.when(known & (F.col(label) == n), F.col("ordinal"))).alias(n)
           for n in names]
    updated = F.max(F.element_at(values(2), -1)).alias("Last update")
    return panes.groupBy(payload_id).agg(*agg, updated)


def pivot_decoded(long: DataFrame, names: Sequence[str], payload_id: str = "payload",
                  fill="0") -> DataFrame:
    """Long decoded values -> one row per (payload, position), one column per
    name; gaps (ragged columns) become ``fill``."""
    wide = long.groupBy(payload_id, "pos").pivot("name", list(names)).agg(F.first("text"))
    return wide.select(payload_id, "pos", *[F.coalesce(F.col(f"`{n}`"), F.lit(fill)).alias(n)
                                            for n in names])


def flatten_hierarchy(pages: DataFrame, levels: Sequence[tuple[str, Sequence[str]]],
                      keep: Sequence[str] = ()) -> DataFrame:
    """Nested ``DM0 -> M -> DM1 -> ...`` members -> leaf rows carrying every
    ancestor's columns (absent fields are null). ``levels`` lists, per depth,
    the array field and the columns to take from its elements. A fixed-depth
    chain of explodes."""
    cur = pages.select(*keep, F.explode_outer(levels[0][0]).alias("__e0"))
    carried = list(keep)
    for depth, (_, cols) in enumerate(levels):
        e = f"__e{depth}"
        cur = cur.select(*carried, e, *[F.col(f"{e}.{c}").alias(c) for c in cols])
        carried = carried + list(cols)
        if depth + 1 < len(levels):
            nxt = levels[depth + 1][0]
            cur = cur.select(*carried, F.explode_outer(F.col(f"{e}.M.{nxt}")).alias(f"__e{depth + 1}"))
    return cur.select(*carried)


def decode_delta_rows(pages: DataFrame, labels: Sequence[str], page_id: str = "page",
                      rows: str = "DM1", values: str = "C", initial=0,
                      keep: Sequence[str] = ()) -> DataFrame:
    """Delta-encoded rows: a row lists only its changed *trailing* values;
    leading ones inherit the previous row of the page (0 before the first).

    Right-align each row (``idx = size(C) - n + i``), then forward-fill each
    column with ``last(..., ignorenulls)`` over the page in row order. The
    window partitions by page, so pages decode in parallel.
    """
    n = len(labels)
    r = pages.select(page_id, *keep, F.posexplode(rows).alias("__ord", "__r"))
    cells = []
    for i, lab in enumerate(labels):
        idx = F.size(F.col(f"__r.{values}")) - F.lit(n - i)
        cells.append(F.when(idx >= 0, F.element_at(F.col(f"__r.{values}"), idx + 1)).alias(lab))
    r = r.select(page_id, *keep, "__ord", *cells)
    w = Window.partitionBy(page_id).orderBy("__ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return r.select(page_id, *keep, F.col("__ord").alias("ordinal"), *[
        F.coalesce(F.last(lab, ignorenulls=True).over(w), F.lit(initial).cast(r.schema[lab].dataType))
        .alias(lab) for lab in labels])


# Stands in front of every string while documents are taken apart, so that a string
# which looks like an object or array is not mistaken for one.
_TEXT = "\ue000"
_STRING = r'"((?:[^"\\]++|\\.)*+)"'


def _depth(j):
    """Levels of objects and arrays in a JSON text."""
    brackets = F.regexp_replace(F.regexp_replace(j, _STRING, ""), r"[^\[\]{}]", "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(a, c):
        now = a["now"] + F.when(c.isin("{", "["), 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(a["most"], now).alias("most"))

    return F.when(brackets == "", 0).otherwise(
        F.aggregate(F.split(brackets, ""), start, lambda a, c: F.when(c == "", a).otherwise(step(a, c)), lambda a: a["most"]))


def flatten_json_long(df: DataFrame, id_col: str, json_col: str, sep: str = "_", max_depth: int | None = None) -> DataFrame:
    """Ragged JSON documents -> long form ``(id, path, ord, value)``, of any depth.

    ``path`` joins object keys and array positions with ``sep`` (``X_0_M0``),
    ``ord`` is the array of positions in document order, ``value`` the leaf
    text. Each level is a single explode: an object yields its entries, an array
    its elements, a scalar passes through as itself, so the plan stays linear in
    the depth and documents of any shape are flattened in parallel without a
    schema. Empty objects and arrays have no leaves.

    With ``max_depth`` the plan has so many levels and no job runs before it does; a
    deeper document fails. Without it the number of levels is measured first (one
    aggregate over the documents). A level reads what is left of a document's objects
    and arrays as text: VARIANT would parse it once, but holds the fields of an object by
    name, and paths are wanted in document order.
    """
    marked = F.regexp_replace(F.col(json_col), _STRING, f'"{_TEXT}$1"')
    depth = max_depth if max_depth is not None else df.agg(F.max(_depth(F.col(json_col)))).first()[0] or 0
    cur = df.select(F.col(id_col).alias("id"), F.lit("").alias("path"),
                    F.array().cast("array<int>").alias("ord"), marked.alias("j"), F.lit(False).alias("leaf"))
    bare = lambda s: F.when(s.startswith(_TEXT), F.substring(s, 2, F.length(s))).otherwise(s)
    for _ in range(depth):
        j = F.col("j")
        t = F.ltrim(j)
        child = lambda k, c: F.struct(k.alias("k"), c.alias("c"), F.lit(False).alias("leaf"))
        obj = F.transform(F.map_entries(F.from_json(j, "map<string,string>")), lambda e: child(bare(e["key"]), e["value"]))
        arr = F.transform(F.from_json(j, "array<string>"), lambda c, i: child(i.cast("string"), c))
        keep = F.array(F.struct(F.lit(None).cast("string").alias("k"), j.alias("c"), F.lit(True).alias("leaf")))
        children = F.when(F.col("leaf"), keep).when(t.startswith("{"), obj).when(t.startswith("["), arr).otherwise(keep)
        x = cur.select("id", "path", "ord", F.posexplode(children).alias("__p", "__c"))
        step = F.col("__c.k")
        cur = x.select(
            "id",
            F.when(F.col("__c.leaf"), F.col("path"))
            .when(F.col("path") == "", step)
            .otherwise(F.concat(F.col("path"), F.lit(sep), step)).alias("path"),
            F.when(F.col("__c.leaf"), F.col("ord"))
            .otherwise(F.concat("ord", F.array(F.col("__p").cast("int")))).alias("ord"),
            F.col("__c.c").alias("j"), F.col("__c.leaf").alias("leaf"))
    if max_depth is not None:
        left = ~F.col("leaf") & F.coalesce(F.ltrim("j").rlike(r"^[\[{]"), F.lit(False))
        cur = cur.withColumn("j", F.when(left, F.raise_error(F.concat(F.lit("document deeper than max_depth: "), F.col("id").cast("string")))
                                         .cast("string")).otherwise(F.col("j")))
    return cur.select("id", "path", "ord", bare(F.col("j")).alias("value"))


def pick_long_by_path_substring(long: DataFrame, wanted: Mapping[str, str]) -> DataFrame:
    """Per document, the value of the first path (document order) that
    contains each substring: one aggregation with ``min_by``."""
    aggs = []
    for out, sub in wanted.items():
        hit = F.col("path").contains(sub)
        aggs.append(F.min_by(F.when(hit, F.col("value")), F.when(hit, F.col("ord"))).alias(out))
    return long.groupBy("id").agg(*aggs)
