"""A landing directory written from the accounts, one scenario per upload.

Every upload is a raw text file built line by line, so that delimiters, headers and row widths can be
wrong.  The number of uploads grows with the data; each is bounded, as one file is written by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import model
from ..plans import files as judge
from ..sinks.writers import shared_dir
from ..sources import files as src
from . import fixtures as fx

# scenario -> what is wrong with the upload
CLEAN, TYPE, NULL, LENGTH, TEXT, KEY, BUSINESS = 0, 1, 2, 3, 4, 5, 6
SEPARATOR, HEADER, WIDTH, UNCONFIGURED, EMPTY, FORMAT, NO_HEADER = 7, 8, 9, 10, 11, 12, 13
N_SCENARIOS = 14
# scenario -> class of fixtures.INJECTED put on every 31st of its rows
CLASS_OF = {TYPE: 3, NULL: 5, LENGTH: 6, TEXT: 7, KEY: 9, BUSINESS: 14}

# scenario = upload % N_SCENARIOS; a scenario gets another upload for every two million of its keys
UPLOAD = f"order_key % {N_SCENARIOS} + {N_SCENARIOS} * (order_key DIV {N_SCENARIOS * 2_000_000})"
_CLASS = "CASE upload % {n} {w} ELSE 0 END".format(
    n=N_SCENARIOS, w=" ".join(f"WHEN {s} THEN {c}" for s, c in CLASS_OF.items())
)
_DEFECT = f"CASE WHEN (order_key DIV 14) % 31 = 3 THEN {_CLASS} ELSE 0 END"
UPLOADS = (
    fx._overridden(
        _DEFECT,
        f"SELECT *, {UPLOAD} AS upload FROM ({fx.ACCOUNTS}) b",
        ", upload",
    )
)


def file_name(upload: Column) -> Column:
    ext = F.when(upload % N_SCENARIOS == FORMAT, ".txt").otherwise(".csv")
    return F.concat(F.lit("drop_"), upload.cast("string"), ext)


def name_of(path: Column) -> Column:
    """Logical file name of a written upload."""
    return file_name(F.regexp_extract(path, "upload=([0-9]+)", 1).cast("bigint"))


_UPLOAD_OF_ORDER = UPLOAD.replace("order_key", "o_orderkey")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value, upload): the lines of every file, each file in one partition and in order.

    The orders are dealt to their files and sorted before they become text: an order with its customer is a fraction of its line.
    """
    scenario = F.col("upload") % N_SCENARIOS
    orders = fx.frame(spark, sf_dir, f"SELECT *, {_UPLOAD_OF_ORDER} AS upload, o_orderkey AS place FROM {fx.ORDERED}")
    # a header has no order; orders without a key are in no file
    found = uploads(spark, sf_dir)
    headers = found.filter(scenario != NO_HEADER).withColumn("place", F.lit(-1).cast("bigint"))
    dealt = orders.filter(scenario != EMPTY).unionByName(headers, allowMissingColumns=True)
    # as many partitions as files, never fewer: a task that sorts several files at once spills
    n = max(1, found.count())
    dealt = dealt.repartitionById(n, F.pmod("upload", F.lit(n)).cast("int")).sortWithinPartitions("upload", "place")
    df = fx.frame(spark, sf_dir, fx._overridden(_DEFECT, fx.accounts_of("dealt", ", upload"), ", upload"), dealt=dealt)
    names = fx.ACCOUNT_COLUMNS

    def cell(n: str) -> Column:
        c = F.coalesce(F.col(n), F.lit(""))
        return F.when(c.contains(","), F.concat(F.lit('"'), c, F.lit('"'))).otherwise(c)

    full = F.array(*[cell(n) for n in names])
    short = F.slice(full, 1, len(names) - 1)
    cut = (scenario == WIDTH) & (F.expr("order_key DIV 14") % 31 == 3)
    swapped = [names[0], names[2], names[1], *names[3:]]
    header = (
        F.when(scenario == SEPARATOR, ";".join(names)).when(scenario == HEADER, ",".join(swapped))
        .otherwise(",".join(names))
    )
    line = (
        F.when(F.col("order_key").isNull(), header)
        .when(cut, F.concat_ws(",", short))
        .when(scenario == SEPARATOR, F.concat_ws(";", full))
        .otherwise(F.concat_ws(",", full))
    )
    return df.select(line.alias("value"), "upload")


_WRITTEN: dict[tuple[str, str, str], str] = {}


def _written(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """The path of what ``write`` makes, once per session and data set."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        path = shared_dir(spark, name)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def directory(spark: SparkSession, sf_dir: str) -> str:
    """Write the landing once per session and data set."""
    return _written(spark, sf_dir, "landing", lambda path: lines(spark, sf_dir).write.partitionBy("upload").text(path))


def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The uploads that have orders, found once per session and data set: headers, and the profiles of every batch, ask for them."""
    found = fx.frame(spark, sf_dir, f"SELECT DISTINCT {_UPLOAD_OF_ORDER} AS upload FROM {fx.ORDERED}")
    return spark.read.schema(found.schema).parquet(_written(spark, sf_dir, "uploads", found.write.parquet))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.list_landing(spark, directory(spark, sf_dir)).withColumn("file_name", name_of(F.col("path")))


def configuration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile per upload but the unconfigured ones; id = upload + 1."""
    scenario = F.col("upload") % N_SCENARIOS
    return uploads(spark, sf_dir).filter(scenario != UNCONFIGURED).select(
        (F.col("upload") + 1).cast("int").alias("id"),
        F.lit("csv").alias("file_format"),
        F.lit("/data/").alias("path"),
        file_name(F.col("upload")).alias("file_name"),
        (scenario != NO_HEADER).alias("has_header"),
        *[F.lit(v).cast("string").alias(c) for c, v in model.PROFILE_DEFAULTS.items() if c != "has_header"],
    )


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All uploads with a header, as raw lines."""
    paths = [r["path"] for r in listing(spark, sf_dir).filter(upload_of("path") % N_SCENARIOS != NO_HEADER).select("path").collect()]
    return src.csv_scan(spark, paths, model.BANK_ACCOUNTS, model.Profile(), upload_of("_metadata.file_path"))


def upload_of(path: str) -> Column:
    return F.regexp_extract(F.col(path), "upload=([0-9]+)", 1).cast("bigint")


def judged(spark: SparkSession, sf_dir: str, book: judge.Rulebook, materialise=None) -> DataFrame:
    return judge.judge_landing(spark, listing(spark, sf_dir), configuration(spark, sf_dir), book, materialise)
