"""Provider payloads landed as JSON, flattened to table rows.

Each reader takes a table with one JSON document per row, the body of one
response page, and keeps the columns named in ``carry`` (provider, repository and
the like). With ``page_no``, a column that numbers the pages as they arrived, the
rows get an ``arrival`` for the merges: the page number and the place in the page.

A page is parsed once, into a variant, and fields are taken from the variants of its items.
Reading is strict: nothing that is there is lost. A page that is no JSON or has not the expected form (cut off, an
error message), an item without its number or id, and a field that is there but cannot be had as its column
(another type, a number beyond it or with a fraction) stop the run with an error that names field and page. Null and absent fields
are null. Labels that are no objects have no name and are passed over. Only a null page, an empty list, and an object
without its list whose ``total_count`` is 0 have no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import remove_nul
from ..functions.timing import utc_timestamp

# Fields of an item and what they hold: a column type, the login of an object, or the names of a list of objects.
ISSUE_ITEM = {
    "number": "int", "title": "string", "body": "string", "user": "login", "state": "string", "state_reason": "string", "comments": "int",
    "labels": "names", "created_at": "string", "closed_at": "string",
}
PULL_ITEM = {
    "number": "int", "title": "string", "user": "login", "state": "string", "created_at": "string", "merged_at": "string", "closed_at": "string",
}
RUN_ITEM = {
    "id": "bigint", "conclusion": "string", "status": "string", "created_at": "string", "updated_at": "string", "head_sha": "string",
}
JOB_ITEM = {
    "id": "bigint", "name": "string", "conclusion": "string", "status": "string", "started_at": "string", "completed_at": "string", "duration_ms": "bigint",
}

INT_MAX = 2**31 - 1
_OBJECT, _LIST = "map<string,variant>", "array<variant>"
_SHAPES = {"string": "string", "int": "decimal(24,4)", "bigint": "decimal(24,4)", "login": "struct<login:string>", "names": _LIST}


def _filled(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def _present(item: Column, path: str) -> Column:
    found = F.variant_get(item, path, "variant")
    return found.isNotNull() & ~F.is_variant_null(found)


def _text(item: Column, path: str) -> tuple[Column, Column]:
    """A text, and whether something else is there."""
    value = F.try_variant_get(item, path, "string")  # of lists and objects their JSON
    nested = F.try_variant_get(item, path, _OBJECT).isNotNull() | F.try_variant_get(item, path, _LIST).isNotNull()
    return value, F.coalesce(F.substring(value, 1, 1).isin("{", "[") & nested, F.lit(False)) | value.isNull() & _present(item, path)


def _problem(item: Column, name: str, kind: str) -> Column:
    """What is wrong with a field; null if it can be had, or is absent or null."""
    path, other = f"$.{name}", F.lit(f"{name} of another type")
    if kind == "login":
        login, wrong = _text(item, f"{path}.login")
        return F.when(wrong | login.isNull() & _present(item, path) & F.try_variant_get(item, path, _OBJECT).isNull(), other)
    if kind == "names":
        return F.when(_present(item, path) & F.try_variant_get(item, path, _LIST).isNull(), other)
    if kind == "string":
        return F.when(_text(item, path)[1], other)
    value = F.try_variant_get(item, path, _SHAPES[kind])
    problem = F.when(_present(item, path) & value.isNull() | (value != F.floor(value)), other)
    return problem.when(F.abs(value) > INT_MAX, F.lit(f"a {name} out of range")) if kind == "int" else problem


def _value(item: Column, name: str, kind: str) -> Column:
    found = item[name]
    if kind == "names":
        objects = F.filter(found, lambda x: F.try_variant_get(x, "$", _OBJECT).isNotNull())
        return F.transform(objects, lambda x: F.coalesce(F.try_variant_get(x, "$.name", "string"), F.lit("")))
    return found["login"] if kind == "login" else found.cast("long") if kind in ("int", "bigint") else found


def _clean(item: Column, cast: Column, name: str, kind: str) -> Column:
    """Whether a field needs no closer look: it is absent or null, or was cast and is no list or object."""
    found, fine = cast[name], F.lit(True)
    if kind in ("string", "login"):  # the text of a list or an object is its JSON
        found = found["login"] if kind == "login" else found
        fine = ~F.substring(found, 1, 1).isin("{", "[")
    elif kind != "names":
        fine = (found == F.floor(found)) & ((F.abs(found) <= INT_MAX) if kind == "int" else F.lit(True))
    return F.when(found.isNull(), ~_present(item, f"$.{name}")).otherwise(fine)


def _items(
    pages: DataFrame, json: str, fields: dict[str, str], listed: str | None, carry: Sequence[str], page_no: str | None, but: str | None = None
) -> DataFrame:
    """One row per item of every page, the carried columns and the arrival in front; items with a field ``but`` are left out."""
    text, key = F.col(json), next(iter(fields))
    known = [page_no] if page_no is not None else []
    where = F.concat_ws(" ", *(F.col(c).cast("string") for c in [*carry, *known]), F.substring(text, 1, 80))
    page = F.try_parse_json(text)
    items = F.try_variant_get(page, "$" if listed is None else f"$.{listed}", _LIST)
    nothing = F.lit(False) if listed is None else F.coalesce(F.try_variant_get(page, "$.total_count", "bigint") == 0, F.lit(False))
    error = F.raise_error(F.concat(F.lit(f"no list of {listed or 'items'} in page: "), where)).cast(_LIST)
    checked = F.when(text.isNull() | items.isNotNull(), items).when(nothing & ~_present(page, f"$.{listed}"), items).otherwise(error)
    number = F.lit(None).cast("long") if page_no is None else F.col(page_no).cast("long")
    placed = pages.select(*carry, number.alias("__page"), where.alias("__where"), F.posexplode(checked).alias("__pos", "__item"))
    item = F.col("__item")
    if but is not None:
        placed = placed.where(F.variant_get(item, f"$.{but}", "variant").isNull())
    shape = ",".join(f"{name}:{_SHAPES[kind]}" for name, kind in fields.items())
    placed = placed.withColumn("__cast", F.try_variant_get(item, "$", f"struct<{shape}>"))
    cast = F.col("__cast")
    clean = cast[key].isNotNull()
    for name, kind in fields.items():
        clean = clean & _clean(item, cast, name, kind)

    def problem(i: Column) -> Column:
        missing = F.when(F.try_variant_get(i, f"$.{key}", _SHAPES[fields[key]]).isNull(), F.lit(f"an item without {key}"))
        return F.coalesce(missing, *(_problem(i, name, kind) for name, kind in fields.items()))

    # In a lambda, as it is looked at for odd items only and would else swell the code for all.
    found = F.when(~clean, F.coalesce(F.transform(F.array(item), problem)[0], F.when(cast.isNull(), F.lit("an item of another form"))))
    stop = F.raise_error(F.concat(found, F.lit(" in page: "), F.col("__where")))
    whole = F.struct(*(_value(cast, name, kind).alias(name) for name, kind in fields.items()))
    rows = placed.withColumn("__item", F.when(found.isNull(), whole).otherwise(stop))
    arrival = [] if page_no is None else [F.struct(F.col("__page").alias("page"), F.col("__pos").alias("place")).alias("arrival")]
    return rows.select(*carry, *arrival, "__item.*")


def _kept(carry: Sequence[str], page_no: str | None) -> list[str]:
    return [*carry] if page_no is None else [*carry, "arrival"]


def issue_rows(
    pages: DataFrame, json: str = "json", carry: Sequence[str] = (), page_no: str | None = None
) -> DataFrame:
    """Issues of list pages; items that are pull requests are dropped."""
    items = _items(pages, json, ISSUE_ITEM, None, carry, page_no, but="pull_request")
    return items.select(
        *_kept(carry, page_no),
        F.col("number").cast("int").alias("issue_number"),
        remove_nul(F.col("title")).alias("title"),
        remove_nul(F.col("body")).alias("body"),
        F.col("user").alias("author"),
        F.coalesce("state", F.lit("open")).alias("state"),
        "state_reason",
        F.coalesce("comments", F.lit(0)).cast("int").alias("comments_count"),
        F.coalesce(F.array_join("labels", ","), F.lit("")).alias("labels"),
        utc_timestamp(F.col("created_at")).alias("created_at"),
        utc_timestamp(F.col("closed_at")).alias("closed_at"),
    )


def pull_rows(
    pages: DataFrame, json: str = "json", carry: Sequence[str] = (), page_no: str | None = None
) -> DataFrame:
    """Pull requests of list pages; a merge time makes the state ``merged``."""
    items = _items(pages, json, PULL_ITEM, None, carry, page_no)
    state = F.when(_filled("merged_at").isNotNull(), "merged").otherwise(F.coalesce("state", F.lit("open")))
    return items.select(
        *_kept(carry, page_no),
        F.col("number").cast("int").alias("pr_number"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.col("user").alias("author"),
        state.alias("state"),
        utc_timestamp(F.col("created_at")).alias("created_at"),
        utc_timestamp(_filled("merged_at")).alias("merged_at"),
        utc_timestamp(F.col("closed_at")).alias("closed_at"),
    )


def run_rows(
    pages: DataFrame, json: str = "json", carry: Sequence[str] = (), page_no: str | None = None
) -> DataFrame:
    """CI runs: conclusion, else status, else ``unknown``."""
    items = _items(pages, json, RUN_ITEM, "workflow_runs", carry, page_no)
    return items.select(
        *_kept(carry, page_no),
        F.col("id").cast("string").alias("pipeline_id"),
        F.coalesce(_filled("conclusion"), _filled("status"), F.lit("unknown")).alias("status"),
        utc_timestamp(F.col("created_at")).alias("created_at"),
        utc_timestamp(F.col("updated_at")).alias("updated_at"),
        F.col("head_sha").alias("sha"),
    )


def job_rows(
    pages: DataFrame, run_id: str, json: str = "json", carry: Sequence[str] = (), page_no: str | None = None
) -> DataFrame:
    """CI jobs of the run whose id stands in column ``run_id``."""
    items = _items(pages, json, JOB_ITEM, "jobs", [*dict.fromkeys([*carry, run_id])], page_no)
    return items.select(
        *_kept(carry, page_no),
        F.col(run_id).cast("string").alias("pipeline_id"),
        F.col("id").cast("string").alias("job_id"),
        "name",
        F.coalesce(_filled("conclusion"), F.col("status")).alias("status"),
        utc_timestamp(F.col("started_at")).alias("started_at"),
        utc_timestamp(F.col("completed_at")).alias("finished_at"),
        F.floor(F.col("duration_ms") / 1000).cast("int").alias("duration_seconds"),
    )
