import random

from pyspark.sql import functions as F

from strandline.functions import seq as S
from strandline.functions import sql
from strandline.functions.align import align
from strandline.operators import stats as T


def test_sql_gives_what_columns_give(spark):
    assert "revcomp" in sql.register(spark)
    sql.register(spark)
    rng = random.Random(3)
    rows = [(k, "".join(rng.choices("ACGTacgtNnR", k=rng.randrange(30))), rng.choice("+-"), rng.choice(["5S10M2I3D4=1X6H", "*", None, "12S"]), rng.choice([None, "", "!I~", "@@@"]), [rng.choice("abc") for _ in range(rng.randrange(1, 5))], rng.randrange(90_000), rng.random() * 100) for k in range(60)]
    df = spark.createDataFrame([*rows, (99, None, None, None, None, ["x"], None, None)], "k long, s string, o string, c string, q string, b array<string>, n long, v double")
    df.createOrReplaceTempView("seqs")
    nodes = F.transform("b", lambda x: F.struct(x.alias("seg"), F.lit("+").alias("orient")))
    pairs = {
        "revcomp(s)": S.revcomp(F.col("s")),
        "oriented(s, o)": S.oriented(F.col("s"), F.col("o")),
        "softclip_length(c)": S.softclip_length(F.col("c")),
        "aligned_query_length(c)": S.aligned_query_length(F.col("c")),
        "mean_phred(q)": S.mean_phred(F.col("q")),
        "cycle_key(b)": S.cycle_key(F.col("b")),
        "path_text(transform(b, x -> named_struct('seg', x, 'orient', '+')))": S.path_text(nodes),
        "contig_status(n)": T.contig_status(F.col("n")),
        "coverage_badge(v)": T.coverage_badge(F.col("v")),
    }
    for text, column in pairs.items():
        assert spark.sql(f"SELECT k, {text} AS x FROM seqs ORDER BY k").collect() == df.select("k", column.alias("x")).orderBy("k").collect(), text
    plan = spark.sql("SELECT revcomp(s) FROM seqs")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_alignment_as_a_table_function(spark):
    sql.register(spark)
    rng = random.Random(4)
    rows = [(k, "".join(rng.choices("ACGT", k=rng.randrange(1, 40))), "".join(rng.choices("ACGT", k=30))) for k in range(300)] + [(300, None, "ACG"), (301, "", "")]
    df = spark.createDataFrame(rows, "id long, query string, target string")
    df.createOrReplaceTempView("pairs")
    got = spark.sql("SELECT * FROM align_pairs(TABLE(SELECT id, query, target FROM pairs))").collect()
    want = align(df).select("id", "align_score", "overlap", "identity").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 302
