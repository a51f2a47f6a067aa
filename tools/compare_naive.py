"""Single pass against one job per rule, same session and data.

usage: python tools/compare_naive.py [sf_dir]
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from pyspark.sql import SparkSession

from dropgate import model
from dropgate.operators import rules as R
from dropgate.plans import verdict as V
from dropgate.session import SETTINGS
from dropgate.sinks.writers import shared_dir
from dropgate.suite import fixtures as fx
from dropgate.suite.base import OPTIONS


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.showConsoleProgress", "false")
        .config(map=SETTINGS).getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    path = shared_dir(spark, "accounts")
    fx.accounts(spark, sf).write.parquet(path)
    df, profile = spark.read.parquet(path), model.Profile()

    def naive():
        business = R.business_frame(df, model.BANK_ACCOUNTS, profile, OPTIONS)
        for r in R.cascade(model.BANK_ACCOUNTS, profile, model.BANK_RULES, OPTIONS):
            if r.phase == "key":
                df.groupBy("account_number").count().filter("count > 1").limit(1).count()
            elif r.condition:
                (business if r.phase == "functional" else df).filter(r.condition).limit(1).count()

    def single():
        V.file_verdicts(df, options=OPTIONS).collect()

    print("rows", df.count())
    for fn in (naive, single):
        times = []
        for _ in range(4):
            t = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t)
        print(fn.__name__, "warm median of 3:", round(sorted(times[1:])[1], 2), "s")


if __name__ == "__main__":
    main()
