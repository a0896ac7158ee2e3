"""Catalog tables: create, replace as a whole, check, register.

A table is a catalog entry over a folder of Parquet files. A replace writes a complete new folder
next to the old one and then points the entry at it, so a plan may read the table it replaces, a
failed write leaves the table as it was, and readers that are already planned keep the old files.

Every change is a numbered commit. A writer remembers the number it planned against; once its files
are complete it claims the next number by a file that only one writer can make, and then changes the
catalog. Of two writers on the same number the second is refused (``Moved``) and has changed nothing.
A claim says what its writer was about to do, so ``recover`` can finish for one that died.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone
from functools import reduce
from operator import and_

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.sources.files import read_entity

# One column or several.
Key = str | Sequence[str]


def exists(spark: SparkSession, name: str) -> bool:
    """Whether the catalog knows ``name``; other errors are not taken for absence."""
    return spark.catalog.tableExists(name)


def require(spark: SparkSession, *names: str) -> None:
    missing = [n for n in names if not exists(spark, n)]
    if missing:
        raise RuntimeError(f"missing source tables: {', '.join(missing)}")


def create_namespace(spark: SparkSession, name: str, root: str) -> None:
    """Make the namespace if it is missing, at home under ``root`` like its tables."""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name} LOCATION '{root}/{name}'")


def create(df: DataFrame, name: str, root: str) -> None:
    """Create ``name`` from ``df``; fails if it is already there."""
    spark = df.sparkSession
    if exists(spark, name):
        raise ValueError(f"table {name} already exists")
    _commit(spark, name, root, 0, {"do": "attach", **_plain(df, _write_version(df, name, root))})


def publish(
    df: DataFrame, name: str, root: str, widen: bool = False, since: int | None = None,
    key: Key | None = None, width: int | None = None,
) -> None:
    """Create ``name`` or replace all its rows; ``df`` may read ``name``.

    The table keeps its columns, their order, their types and its ranges; columns new in ``df`` are
    added at its end. A ``df`` that lacks a column, or has one in a type that does not fit into the
    table's, is refused. ``widen`` lets a column of the table grow to a larger type of its kind.
    ``since`` is the ``version`` that ``df`` was planned against, if that is older than this call.
    ``key`` and ``width`` cut a table by ranges that is in one piece so far.

    With added columns the catalog takes two statements; a reader between them sees the new columns
    as null.
    """
    spark = df.sparkSession
    if not exists(spark, name):
        rebuild(df, name, root, key, width)
        return
    since = version(spark, name) if since is None else since
    shaped, added, grown = _shaped(df, name, widen)
    own = ranges_of(spark, name)
    if grown or own or _agreed(name, own, key, width):
        rebuild(shaped, name, root, None if own else key, None if own else width, since)
    else:
        location = _write_version(shaped, name, root)
        _commit(spark, name, root, since, {"do": "point", "location": location, "added": added})


def _shaped(df: DataFrame, name: str, widen: bool = False) -> tuple[DataFrame, dict[str, str], list[str]]:
    """``df`` in the columns and types of ``name``, the columns it adds and those that grow."""
    old, new = _columns(_unranged(df.sparkSession, name)), _columns(df)
    lost = [n for n in old if n not in new]
    if lost:
        raise ValueError(f"{name} would lose columns: {', '.join(lost)}")
    grown = [n for n, t in old.items() if new[n] != t and _fits(t, new[n])]
    unfit = [n for n, t in old.items() if new[n] != t and not _fits(new[n], t) and n not in grown]
    if unfit or grown and not widen:
        raise ValueError(f"{name} would change the types of: {', '.join(unfit or grown)}")
    added = {n: t for n, t in new.items() if n not in old}
    kept = [F.col(f"`{n}`").cast(new[n] if n in grown else t).alias(n) for n, t in old.items()]
    return df.select(*kept, *(F.col(f"`{n}`") for n in added)), added, grown


# Types that hold every value of those before them.
_WIDER = (("tinyint", "smallint", "int", "bigint"), ("float", "double"))


def _fits(small: str, large: str) -> bool:
    return any(small in w and large in w and w.index(small) < w.index(large) for w in _WIDER)


def rebuild(
    df: DataFrame, name: str, root: str, key: Key | None = None, width: int | None = None, since: int | None = None
) -> None:
    """Create ``name`` or replace it together with its columns and their order.

    A table that is cut by ranges of its key stays so, with its own width; ``key`` and ``width`` are
    for a table that is not there or not cut yet.

    The catalog cannot take columns away. If columns or ranges differ, the new files get an entry
    under a temporary name, and the two entries change names; if the second rename fails, the first
    is taken back. Between the renames, an instant, ``name`` is not there; no step before them
    touches the old table, and ``recover`` finishes for a writer that died in between.
    """
    spark = df.sparkSession
    there = exists(spark, name)
    since = since if since is not None else version(spark, name) if there else 0
    cut = _agreed(name, ranges_of(spark, name) if there else None, key, width)
    if cut:
        made = {"key": cut[0], "width": cut[1], **_plain(df, _write_ranges(_ranged(df, *cut), name, root))}
    else:
        made = _plain(df, _write_version(df, name, root))
    if not there:
        _commit(spark, name, root, since, {"do": "attach", **made})
    elif not cut and list(_columns(spark.table(name)).items()) == list(_columns(df).items()):
        _commit(spark, name, root, since, {"do": "point", "location": made["location"], "added": {}})
    else:
        mark = uuid.uuid4().hex[:12]
        names = {"fresh": f"{name}_new_{mark}", "old": f"{name}_old_{mark}"}
        _commit(spark, name, root, since, {"do": "swap", **names, **made})


def _plain(df: DataFrame, location: str) -> dict:
    return {"location": location, "schema": df.schema.json()}


def _rename(spark: SparkSession, name: str, to: str) -> None:
    spark.sql(f"ALTER TABLE {name} RENAME TO {to}")


# --- commits -------------------------------------------------------------------------------------

VERSION, KEY, WIDTH = "layerloom.version", "layerloom.range.key", "layerloom.range.width"
# In place of KEY for a key of several columns: their names as JSON.
KEYS = "layerloom.range.keys"


class Moved(RuntimeError):
    """Another writer committed, or claimed, what this one was about to."""


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def version(spark: SparkSession, name: str) -> int:
    """The number of the last commit of ``name``; 0 for a table this library did not write."""
    return int(_properties(spark, name).get(VERSION, 0))


def _set(spark: SparkSession, name: str, **properties) -> None:
    pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def _home(name: str, root: str) -> str:
    return "/".join([root.rstrip("/"), *name.split(".")])


def _claims(spark: SparkSession, name: str, root: str) -> list[int]:
    folder, fs = _path(spark, f"{_home(name, root)}/_commits")
    if not fs.exists(folder):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(folder))
    return sorted(int(n) for n in names if n.isdigit())


def _claim(spark: SparkSession, name: str, root: str, number: int, change: Mapping) -> None:
    place, fs = _path(spark, f"{_home(name, root)}/_commits/{number}")
    try:
        out = fs.create(place, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            raise Moved(f"commit {number} of {name} is claimed by another writer; recover() finishes for one that died") from e
        raise
    out.write(bytearray(json.dumps(change).encode()))
    out.close()


def _claimed(spark: SparkSession, name: str, root: str, number: int) -> dict:
    place, _ = _path(spark, f"{_home(name, root)}/_commits/{number}")
    return json.loads("\n".join(r[0] for r in spark.read.text(place.toString()).collect()))


def _commit(spark: SparkSession, name: str, root: str, since: int, change: dict) -> None:
    """Change the catalog for files that are complete, unless ``name`` is no longer at ``since``."""
    if exists(spark, name):
        now = version(spark, name)
        if now != since or change["do"] == "attach":
            raise Moved(f"{name} is at commit {now}, not at {since} any more")
    else:
        # A name that was dropped goes on counting where it was.
        since = max(_claims(spark, name, root), default=0)
    _claim(spark, name, root, since + 1, change)
    try:
        _apply(spark, name, since + 1, change)
    except Exception:
        # Nothing changed, or it was taken back; a writer that dies instead leaves its claim.
        if not exists(spark, name) or version(spark, name) != since + 1:
            place, fs = _path(spark, f"{_home(name, root)}/_commits/{since + 1}")
            fs.delete(place, False)
        raise


def _apply(spark: SparkSession, name: str, number: int, change: dict) -> None:
    """The catalog's part of a commit. Each step looks whether it is done, so it may run again."""
    if change["do"] == "attach":
        _attach(spark, name, change, number)
    elif change["do"] == "point":
        _point(spark, name, change["location"], change["added"])
        _set(spark, name, **{VERSION: number})
    elif change["do"] == "ranges":
        _add_columns(spark, name, change["added"])
        _repoint(spark, name, change["location"], change["touched"])
        _set(spark, name, **{VERSION: number})
    else:
        _swap(spark, name, number, change)


def _swap(spark: SparkSession, name: str, number: int, change: dict) -> None:
    fresh, old = change["fresh"], change["old"]
    if not (exists(spark, name) and version(spark, name) == number):
        if not exists(spark, fresh):
            _attach(spark, fresh, change, number)
        if exists(spark, name):
            _rename(spark, name, old)
        try:
            _rename(spark, fresh, name)
        except Exception:
            _rename(spark, old, name)
            spark.sql(f"DROP TABLE IF EXISTS {fresh}")
            raise
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def recover(spark: SparkSession, name: str, root: str) -> bool:
    """Finish the last commit of a writer that died during it; whether there was anything to do.

    The files of a claimed commit are complete, so it is always finished, never undone. Call it only
    when that writer cannot be running any more.
    """
    last = max(_claims(spark, name, root), default=0)
    if not last:
        return False
    change = _claimed(spark, name, root, last)
    done = exists(spark, name) and version(spark, name) >= last
    if done and not (change["do"] == "swap" and exists(spark, change["old"])):
        return False
    _apply(spark, name, last, change)
    return True


def location_of(spark: SparkSession, name: str) -> str | None:
    """Where the files of ``name`` are; ``None`` for a view."""
    return _described(spark, name)


def _described(spark: SparkSession, what: str) -> str | None:
    # A table may have a column of that name, so only what follows the columns counts.
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {what}").collect()
    heads = [k for k, r in enumerate(rows) if r["col_name"].startswith("# Detailed")]
    after = rows[heads[0] :] if heads else []
    return next((r["data_type"] for r in after if r["col_name"] == "Location"), None)


def _path(spark: SparkSession, place: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, place: str) -> bool:
    path, fs = _path(spark, place)
    return fs.exists(path)


def expire(spark: SparkSession, name: str, root: str, keep: int = 1) -> list[str]:
    """Remove files of replaced versions of ``name``, all but the ``keep`` latest; what the table
    points at always stays. Readers that were planned on a removed version fail, so run it when
    none can be left. Returns the removed folders."""
    home, fs = _path(spark, "/".join([root.rstrip("/"), *name.split(".")]))
    if not fs.exists(home):
        return []
    used = {_last(location_of(spark, name) or "")} if exists(spark, name) else set()
    if exists(spark, name) and ranges_of(spark, name):
        used |= {_last(p.rpartition("/")[0]) for p in _range_locations(spark, name).values()}
    found = sorted(s.getPath().getName() for s in fs.listStatus(home) if s.isDirectory())
    old = [v for v in found if _VERSION.fullmatch(v) and v not in used]
    gone = old[: len(old) - keep] if keep else old
    for version in gone:
        fs.delete(_path(spark, f"{home}/{version}")[0], True)
    return gone


def _last(path: str) -> str:
    return path.rstrip("/").rpartition("/")[2]


@contextmanager
def staged(df: DataFrame, root: str) -> Iterator[DataFrame]:
    """``stage`` for as long as the block runs; its folder is removed afterwards."""
    path = f"{root}/{_version()}"
    try:
        df.write.parquet(path)
        yield read_entity(df.sparkSession, path, schema=df.schema)
    finally:
        place, fs = _path(df.sparkSession, path)
        fs.delete(place, True)


def stage(df: DataFrame, root: str) -> DataFrame:
    """Write ``df`` once and read it back.

    For a batch that feeds several branches of a plan: it is computed a single time, its size is
    known to the planner from the files, and a lost executor costs a re-read, not a re-run.
    """
    path = f"{root}/{_version()}"
    df.write.parquet(path)
    return read_entity(df.sparkSession, path, schema=df.schema)


_VERSION = re.compile(r"\d{8}T\d{6}-[0-9a-f]{12}")


def _version() -> str:
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"


def _write_version(df: DataFrame, name: str, root: str) -> str:
    location = "/".join([root.rstrip("/"), *name.split("."), _version()])
    df.write.option("compression", "snappy").parquet(location)
    return location


def _columns(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def _attach(spark: SparkSession, name: str, made: Mapping, number: int) -> None:
    """An entry for complete files, its properties included, in one statement (and one more that
    finds the ranges)."""
    schema = T.StructType.fromJson(json.loads(made["schema"]))
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema]
    properties = {VERSION: number}
    by = ""
    if "key" in made:
        columns.append(f"{RANGE} BIGINT")
        named = {KEY: made["key"]} if isinstance(made["key"], str) else {KEYS: json.dumps(made["key"])}
        properties |= {**named, WIDTH: made["width"]}
        by = f"PARTITIONED BY ({RANGE}) "
    pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(
        f"CREATE TABLE {name} ({', '.join(columns)}) USING parquet {by}"
        f"LOCATION '{made['location']}' TBLPROPERTIES ({pairs})"
    )
    if by:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def _add_columns(spark: SparkSession, name: str, added: Mapping[str, str]) -> None:
    missing = {n: t for n, t in added.items() if n not in _columns(spark.table(name))}
    if missing:
        columns = ", ".join(f"`{n}` {t}" for n, t in missing.items())
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")


def _point(spark: SparkSession, name: str, location: str, added: Mapping[str, str]) -> None:
    _add_columns(spark, name, added)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    spark.catalog.refreshTable(name)


def view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def drop(spark: SparkSession, names: Sequence[str]) -> None:
    """Remove catalog entries; their files stay."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


# --- tables cut by ranges of their key ------------------------------------------------------------

# The partition column: the whole part of place / width; null for null keys.
RANGE = "key_range"


def key_names(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def place(df: DataFrame, key: Key) -> Column:
    """The number that says in which range a row lies: equal keys have equal places.

    Whole numbers and decimals are their own place, dates the day and timestamps the second since
    1970, so keys that come together lie together. Any other type, and a key of several columns, is
    placed by a hash from 0 to 2^31 - 1, evenly and without an order. A key with a null has none.
    Nested columns are refused.
    """
    names = key_names(key)
    kinds = [f.dataType for f in df.select(*names).schema]
    nested = [n for n, t in zip(names, kinds) if not isinstance(t, T.AtomicType)]
    if nested:
        raise ValueError(f"no ranges over the nested columns {', '.join(nested)}")
    columns, kind = [_one_zero(F.col(n), t) for n, t in zip(names, kinds)], kinds[0]
    if len(names) == 1 and isinstance(kind, (T.IntegralType, T.DecimalType)):
        return columns[0]
    if len(names) == 1 and isinstance(kind, T.DateType):
        return F.unix_date(columns[0])
    if len(names) == 1 and isinstance(kind, T.TimestampType):
        return F.unix_seconds(columns[0])
    whole = reduce(and_, (c.isNotNull() for c in columns))
    return F.when(whole, F.shiftrightunsigned(F.xxhash64(*columns), 33))


def _one_zero(column: Column, kind: T.DataType) -> Column:
    # Joins take -0.0 for 0.0, hashes do not.
    return F.when(column == 0, F.lit(0).cast(kind)).otherwise(column) if isinstance(kind, T.FractionalType) else column


def _ranged(df: DataFrame, key: Key, width: int) -> DataFrame:
    return df.withColumn(RANGE, F.floor(place(df, key) / F.lit(width)).cast("long"))


def _write_ranges(df: DataFrame, name: str, root: str) -> str:
    location = "/".join([root.rstrip("/"), *name.split("."), _version()])
    df.hint("rebalance", F.col(RANGE)).write.option("compression", "snappy").partitionBy(RANGE).parquet(location)
    return location


def ranges_of(spark: SparkSession, name: str) -> tuple[Key, int] | None:
    """Key and width of a table that is cut by ranges; they are the table's own for good."""
    found = _properties(spark, name)
    if KEYS in found:
        return tuple(json.loads(found[KEYS])), int(found[WIDTH])
    return (found[KEY], int(found[WIDTH])) if KEY in found else None


def _unranged(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).drop(RANGE)


def _agreed(
    name: str, own: tuple[Key, int] | None, key: Key | None, width: int | None
) -> tuple[Key, int] | None:
    """The table's ranges, or those wanted for a table that has none."""
    if own is None:
        return (key, width) if key is not None and width is not None else None
    if width is not None and width != own[1]:
        raise ValueError(f"{name} is cut by {own[1]} values of {own[0]}, not by {width}")
    return own


def width_for(df: DataFrame, key: Key, rows: int) -> int:
    """The width at which ranges of ``key`` hold about ``rows`` rows, were keys spread evenly."""
    k = place(df, key)
    found = df.agg(F.count(k).alias("n"), F.min(k).alias("low"), F.max(k).alias("high")).first()
    if not found["n"]:
        return rows
    return max(1, int(-(-(found["high"] - found["low"] + 1) * rows // found["n"])))


def _partitions(spark: SparkSession, name: str):
    """The catalog's entries of all ranges, in one call. SQL can only describe them one by one."""
    state = spark._jsparkSession.sessionState()
    table = state.sqlParser().parseTableIdentifier(name)
    found = state.catalog().listPartitions(table, spark._jvm.scala.Option.empty())
    entries = [found.apply(k) for k in range(found.size())]
    return state.catalog(), table, {e.spec().apply(RANGE): e for e in entries}


_NO_KEY = "__HIVE_DEFAULT_PARTITION__"


def _range_locations(spark: SparkSession, name: str) -> dict[str, str]:
    """Range to location; as many rows as the table has ranges."""
    return {k: e.location().toString() for k, e in _partitions(spark, name)[2].items()}


def _repoint(spark: SparkSession, name: str, location: str, touched: Sequence[str]) -> None:
    """Point these ranges at their folders in ``location``, all in one call to the catalog.

    Ranges the table did not have come first, with an empty folder, so that readers see all of the
    change or nothing of it.
    """
    empty = f"{location}/_empty"
    place, fs = _path(spark, empty)
    fs.mkdirs(place)
    catalog, table, known = _partitions(spark, name)
    fresh = [t for t in touched if t not in known]
    if fresh:
        specs = " ".join(f"PARTITION ({RANGE} = {'NULL' if t == _NO_KEY else t}) LOCATION '{empty}'" for t in fresh)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")
        catalog, table, known = _partitions(spark, name)
    some, root = spark._jvm.scala.Option, _path(spark, location)[0].toUri().toString()
    uri = spark._jvm.java.net.URI
    # All entries of a table are alike but for range and place; what was known of the old files goes.
    like = known[touched[0]]
    kept = [like.storage().productElement(k) for k in range(1, like.storage().productArity())]
    made, seen, gone = like.createTime(), like.lastAccessTime(), some.empty()
    nothing = spark._jvm.PythonUtils.toScalaMap({})
    moved = []
    for value in touched:
        storage = like.storage().copy(some.apply(uri(f"{root}/{RANGE}={value}")), *kept)
        moved.append(like.copy(known[value].spec(), storage, nothing, made, seen, gone))
    catalog.alterPartitions(table, spark._jvm.PythonUtils.toSeq(moved))
    spark.catalog.refreshTable(name)


def create_ranges(df: DataFrame, name: str, root: str, key: Key, width: int) -> None:
    """Create ``name`` as a table that is partitioned by ranges of ``width`` places of ``key``; both
    are kept with the table."""
    spark = df.sparkSession
    if exists(spark, name):
        raise ValueError(f"table {name} already exists")
    rebuild(df, name, root, key, width)


def upsert_ranges(
    batch: DataFrame,
    name: str,
    root: str,
    combine: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame],
    since: int | None = None,
) -> None:
    """Combine a staged ``batch`` into ``name``, reading and writing only the ranges it has keys in.

    Key and width are the table's. The touched ranges are written as a whole new version and
    committed together. Columns that ``combine`` adds are added to the table.
    """
    spark = batch.sparkSession
    since = version(spark, name) if since is None else since
    key, width = ranges_of(spark, name)
    names = key_names(key)
    # A hash depends on the type, and a batch may come with a smaller one.
    of, held = _columns(batch.select(*names)), _columns(spark.table(name).select(*names))
    alike = batch.select(*(F.col(n).cast(t) if _fits(of[b], t) else F.col(n) for (n, t), b in zip(held.items(), of)))
    # As many rows as there are ranges: the catalog has an entry for each.
    touched = [r[0] for r in _ranged(alike.toDF(*held), key, width).select(RANGE).distinct().collect()]
    if not touched:
        return
    column = F.col(RANGE)
    inside = column.isin([t for t in touched if t is not None])
    if None in touched:
        inside = inside | column.isNull()
    existing = spark.table(name).where(inside).drop(RANGE)
    merged, added, grown = _shaped(combine(existing, batch, names), name)
    location = _write_ranges(_ranged(merged, key, width), name, root)
    values = [_NO_KEY if t is None else str(t) for t in touched]
    _commit(spark, name, root, since, {"do": "ranges", "location": location, "added": added, "touched": values})
