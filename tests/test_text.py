import pytest
from pyspark.sql import functions as F

from reviewmill.functions import text as T
from reviewmill.plans.fixtures import LEXICON, read_fixture

WORDS = "text string"


def labels(spark, texts, lexicon, **options):
    df = spark.createDataFrame([(t,) for t in texts], WORDS)
    return [r.sentiment for r in T.label_sentiment(df, lexicon, **options).collect()]


def test_sign_decides_the_label(spark):
    lexicon = {"good": 0.7, "bad": -0.7, "odd": 0.0}
    texts = ["Good", "BAD bad good", "good bad", "odd", "nothing here", "", None]
    assert labels(spark, texts, lexicon) == [
        "Positive", "Negative", "Neutral", "Neutral", "Neutral", "Neutral", None,
    ]


def test_tokens_are_runs_of_letters(spark):
    texts = ["goods", "so-good!", "good1bad", "GOOD\nbad bad", "bonégood", "schön für ÜBER über", "добро_x"]
    lexicon = {"good": 1.0, "bad": -1.0, "schön": 1.0, "über": -1.0, "добро": 1.0}
    assert labels(spark, texts, lexicon) == [
        "Neutral", "Positive", "Neutral", "Negative", "Neutral", "Negative", "Positive",
    ]


def test_empty_lexicon_is_neutral(spark):
    assert labels(spark, ["good", None], {}) == ["Neutral", None]


def test_sums_do_not_depend_on_rounding(spark):
    # 0.1 + 0.2 - 0.3 is not zero in binary floating point.
    lexicon = {"a": 0.1, "b": 0.2, "c": -0.3}
    assert labels(spark, ["a b c", "c b a"], lexicon) == ["Neutral", "Neutral"]


def test_many_words_and_weights(spark):
    words = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(400)]
    lexicon = {w: ((i * 7) % 41 - 20) / 20 for i, w in enumerate(words)}
    df = spark.createDataFrame([(w, float(v)) for w, v in lexicon.items()], "t string, w double")
    weights = T.literal_weights(spark, lexicon)
    got = df.select("w", T.polarity(F.col("t"), weights).alias("p")).collect()
    assert all(r.p == pytest.approx(r.w) for r in got)


def test_polarity_is_the_mean_weight(spark):
    df = spark.createDataFrame([("good good bad x",), ("x",), (None,)], WORDS)
    weights = T.literal_weights(spark, {"good": 0.5, "bad": -0.25})
    got = [r[0] for r in df.select(T.polarity(F.col("text"), weights)).collect()]
    assert got == [0.25, 0.0, None]


def test_repeated_lexicon_words_take_their_mean(spark):
    lexicon = spark.createDataFrame(
        [("Good", 1.0), ("good", 0.5), ("x", None), (None, 1.0)], "word string, weight double"
    )
    assert T.literal_weights(spark, lexicon) == {"good": 750_000}
    assert T.literal_weights(spark, {"Good": 1.0, "good": 0.5}) == {"good": 750_000}


def test_labels_do_not_depend_on_the_size_of_the_lexicon(spark, monkeypatch):
    lexicon = {"Good": -0.8, "good": 0.5, "odd": 0.0000005}
    texts = ["good good", "Good", "odd", None, "", "good odd"]
    few = labels(spark, texts, lexicon)
    monkeypatch.setattr(T, "LITERAL_WORDS", 1)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    many = T.label_sentiment(df, lexicon).orderBy("i").collect()
    looked_up = T.label_by_lookup(df, T.lexicon_table(spark, lexicon)).orderBy("i").collect()
    assert few == [r.sentiment for r in many] == [r.sentiment for r in looked_up]
    assert few[0] == "Negative" and few[2] == "Positive"


def test_all_ways_agree_on_whole_texts(spark, sf_dir, rows, monkeypatch):
    reviews = read_fixture(spark, sf_dir, "review").select("review_id", "text")
    literal = rows(T.label_sentiment(reviews, LEXICON), "review_id", "sentiment")
    monkeypatch.setattr(T, "LITERAL_WORDS", 3)
    assert T.literal_weights(spark, LEXICON) is None
    joined = T.label_sentiment(reviews, LEXICON)
    assert rows(joined, "review_id", "sentiment") == literal
    table = spark.createDataFrame(list(LEXICON.items()), "word string, weight double")
    assert rows(T.label_sentiment(reviews, table), "review_id", "sentiment") == literal
    looked_up = T.label_by_lookup(reviews, table)
    assert rows(looked_up, "review_id", "sentiment") == literal
    assert {label for _, label in literal} == {"Positive", "Neutral", "Negative", None}


def test_join_form_keeps_copies_and_nulls(spark):
    texts = ["good bad bad"] * 5 + ["good"] * 3 + [None, None, ""]
    df = spark.createDataFrame([(t,) for t in texts], WORDS)
    lexicon = spark.createDataFrame([("good", 1.0), ("bad", -1.0)], "word string, weight double")
    got = sorted((r.sentiment for r in T.label_by_join(df, lexicon).collect()), key=repr)
    assert got == ["Negative"] * 5 + ["Neutral"] + ["Positive"] * 3 + [None] * 2


def test_scorer(spark):
    def score(text):
        return float(len(text) - 3)

    assert labels(spark, ["abcd", "abc", "a", None], None, scorer=score) == [
        "Positive", "Neutral", "Negative", None,
    ]


def test_needs_lexicon_or_scorer(spark):
    with pytest.raises(ValueError):
        labels(spark, ["a"], None)


def test_large_lexicon_on_a_stream(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "LITERAL_WORDS", 1)
    spark.createDataFrame([("good bad bad",), (None,), ("x",)], WORDS).write.text(str(tmp_path / "in"))
    stream = spark.readStream.text(str(tmp_path / "in")).withColumnRenamed("value", "text")
    labelled = T.label_sentiment(stream, {"good": 1.0, "bad": -1.0})
    query = labelled.writeStream.format("memory").queryName("labelled").trigger(availableNow=True).start()
    query.awaitTermination()
    got = {r.text: r.sentiment for r in spark.table("labelled").collect()}
    assert got["good bad bad"] == "Negative" and got["x"] == "Neutral"


def test_a_negator_turns_the_next_word(spark, monkeypatch):
    texts = ["not good", "Not, good good good", "not so good", "good not", "not not good", "not bad", None, ""]
    lexicon, expected = {"good": 1.0, "bad": -1.0, "so": 0.0}, [
        "Negative", "Positive", "Positive", "Positive", "Negative", "Positive", None, "Neutral",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    table = T.with_negated(T.lexicon_table(spark, lexicon))
    looked_up = T.label_by_lookup(df, table, negators=["NOT"]).orderBy("i").collect()
    assert [r.sentiment for r in looked_up] == expected
    for most in (20_000, 1):
        monkeypatch.setattr(T, "LITERAL_WORDS", most)
        got = T.label_sentiment(df, lexicon, negators=["not"]).orderBy("i").collect()
        assert [r.sentiment for r in got] == expected


def test_read_lexicon(spark, tmp_path):
    good = [("good", 0.5), ("schön", 1.0)]
    for n, more in enumerate(([], [("two words", 0.5)], [("x", 2.0)], [(None, 0.5)], [("y", None)])):
        path = str(tmp_path / str(n))
        spark.createDataFrame(good + more, "word string, weight double").write.parquet(path)
        if more:
            with pytest.raises(ValueError, match="lexicon entry"):
                T.read_lexicon(spark, path)
        else:
            assert sorted(map(tuple, T.read_lexicon(spark, path).collect())) == good


def test_mapping_and_table_are_weighed_alike(spark):
    lexicon = {"good": 0.5, "bad": -0.1234565, "fine": 1e-7, "odd": 0.3000005, "poor": -0.0000005}
    table = T.lexicon_table(spark, lexicon)
    assert T.literal_weights(spark, lexicon) == T.literal_weights(spark, table)
    spelled = {"Good": 0.5, "good": 0.25}
    assert T.literal_weights(spark, spelled) == {"good": 375_000}


def test_lookup_refuses_what_no_executor_should_hold(spark, monkeypatch):
    monkeypatch.setattr(T, "LOOKUP_WORDS", 2)
    df = spark.createDataFrame([("a",)], WORDS)
    with pytest.raises(ValueError, match="label_by_join"):
        T.label_by_lookup(df, T.lexicon_table(spark, {"a": 1.0, "b": 1.0, "c": 1.0}))
    assert T.label_by_lookup(df, T.lexicon_table(spark, {"a": 1.0, "b": 1.0})).first().sentiment == "Positive"
