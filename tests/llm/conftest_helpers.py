import re


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plan_has_python(df):
    return bool(re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString()))
