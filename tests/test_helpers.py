from pyspark.sql import functions as F

from estuary.functions.exprs import py_round

from estuary.functions.exprs import let
from estuary.operators import serving as SV
from estuary.operators import text as X


def test_chat_gen_params(spark):
    df = spark.createDataFrame([("vicuna-7b", None, "P", [("user", "hi")]), ("chatglm-6b", 64, "P", [("user", "hi")])],
                               "model string, max_tokens int, prompt string, messages array<struct<role:string,content:string>>")
    rows = {r.model: (r.gen_max_tokens, r.gen_prompt) for r in X.chat_gen_params(df).collect()}
    assert rows["vicuna-7b"] == (512, "P")
    assert rows["chatglm-6b"][0] == 64 and rows["chatglm-6b"][1].startswith("[{")


def test_generation_budget(spark):
    df = spark.createDataFrame([(100, 2048, 1000, 0), (100, 2048, 2000, 0), (100, 2048, 1948, 100)],
                               "mx int, ctx int, tok int, img int")
    got = [r.b for r in df.select(SV.generation_budget(F.col("mx"), F.col("ctx"), F.col("tok"), F.col("img")).alias("b")).collect()]
    assert got == [100, 48, None]



def test_let_binds_value(spark):
    df = spark.createDataFrame([("abc",)], "s string")
    out = df.select(let(F.upper("s"), lambda v: F.concat(v, F.lit("-"), v)).alias("o")).first().o
    assert out == "ABC-ABC"


def test_py_round_is_pythons(spark):
    """Half-even on the exact binary value, also where the shortest decimal text ends in 5."""
    values = [1704097739.36385, 1704097739.36375, 1.00005, 1.00015, 2.67505, -2.67515, 123456789.98765, 0.0, 0.25, 1e-9]
    df = spark.createDataFrame([(v,) for v in [*values, float("nan"), float("inf")]], "v double")
    got = [r.x for r in df.select(py_round("v", 4).alias("x")).collect()]
    assert got[:len(values)] == [round(v, 4) for v in values]
    assert got[-2] != got[-2] and got[-1] == float("inf")
