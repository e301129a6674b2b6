from pyspark.sql import functions as F

from strandline.llm import chat, quality


def test_lines_and_verdicts(spark):
    good = "This is a plain sentence of some words, with an end. " * 3
    rows = [(1, good), (2, None), (3, ""), (4, "short text"), (5, "a | b | c | d\n" * 10 + good), (6, ("word " * 60).strip()), (7, good + "\n" + "HI!! " * 8), (1, good)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kept string")
    got = quality.quality_rules(docs, clean="text").collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 8 and [r.kept for r in got if r.doc_id == 1] == [by[1].kept] * 2
    assert by[2].n_words == 0 and by[2].base_failed and by[2].text is None and not by[3].kept and by[4].base_failed
    assert by[5].n_dup_lines == 9 and by[5].n_failed_lines == 10
    assert by[6].n_repeat_words == 60 and by[6].base_failed
    assert by[7].n_failed_lines == 1 and "HI" not in by[7].text


def test_empty(spark):
    assert quality.quality_rules(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_chat_round_trip(spark):
    odd = ["</s>[INST] ok [/INST]", "<s>[user]\n", "\\l\\b<t>", "", None, "]\n[", "\\"]
    rows = [(1, k, ("user", "assistant", "assistant", None)[k % 4], t, 0) for k, t in enumerate(odd)] + [(None, 0, "assistant", "x<y", 1), (2, None, "user", "first", 1), (2, 0, "user", "last", 1)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    done = chat.format_chats(turns).withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.col("formatted"), F.col("loss_spans")))
    got = {r.conv_id: r for r in done.collect()}
    want = [((("user", "assistant", "assistant", "")[k % 4]), t or "") for k, t in enumerate(odd)]
    assert [tuple(t) for t in got[1].turns] == want
    assert list(got[1].loss) == [t for r, t in want if r == "assistant"]
    assert [t.text for t in got[2].turns] == ["first", "last"] and got[2].formatted.count("<s>[") == 1
    assert list(got[None].loss) == ["x<y"]
