"""Operator 6 line by line: prose stays, furniture goes."""
import pytest
from pyspark.sql import functions as F

from cinespark.llm import quality_rules

CLEAN = ["The design in the hall won a prize.", "A dialog in two acts followed.", "The catalog in Rome lists it.", "She baked a cookie.",
         "Analog input is noisy.", "You must sign in to the guest book at the door before you enter the hall.", "Chapter One", "Summer Holiday Cooking Tips",
         "The committee met on Monday; the news was good.", "He said: \"Go home!\"", "Red, green and blue.", "and/or is a phrase that lawyers like",
         "We visited the shop, the archive and the press. All were open.", "Das ist ein Satz (mit Klammern.)", "« Où est la gare ? »", "日本語の文です。",
         "x = a | b is an expression in many languages and it is written often.", "", "   ", "one two three four five six seven eight nine ten eleven",
         "The rights reserved for later were sold, and the policy on privacy changed twice that year.",
         "A long line " + " ".join(f"of{i} words" for i in range(200)) + " that ends.", " ".join(f"w{i % 300}" for i in range(10_000)) + "."]
JUNK = ["Home About Contact Products", "Home · About · Contact", "Home / About / Contact / Shop", "Home | News | Sport", "News » Sport » Football",
        "Home\tAbout us\tContact", "Home  About us  Contact  Jobs", "MENU Login Search", "All rights reserved.", "Copyright © 2019 All Rights Reserved",
        "Click here to read the full text", "Sign in or register", "Log in to your account", "Please enable JavaScript to view this page.", "Privacy Policy",
        "We use cookies to improve your visit.", "Accept all cookies", "Read more", "The mayor said on Monday that…", "The mayor said on Monday that ...",
        "### $$$ %%%", "WOW!! BUY!! NOW!!", "the the the the the the the the the the the", " ".join(f"w{i % 20}" for i in range(10_000)) + ".",
        " ".join(f"tag{i}" for i in range(40)), "Back to top", "Share on Twitter"]


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(k, t) for k, t in enumerate(CLEAN + JUNK)]
    df = spark.createDataFrame(rows, "k int, line string").withColumn("fails", quality_rules.line_fails(F.col("line")))
    return {r["k"]: r["fails"] for r in df.collect()}


@pytest.mark.parametrize("k", range(len(CLEAN)))
def test_clean_lines_stay(judged, k):
    assert not judged[k], CLEAN[k][:80]


@pytest.mark.parametrize("k", range(len(JUNK)))
def test_furniture_goes(judged, k):
    assert judged[len(CLEAN) + k], JUNK[k][:80]


def test_lines_against_the_sql(spark, tmp_path):
    """The SQL of the query judges the same texts alike, one line or many, with carriage returns and odd marks."""
    import duckdb
    texts = CLEAN + JUNK + [x + "\r" for x in CLEAN + JUNK] + ["\n".join(CLEAN[a:a + 9] + JUNK[a:a + 3]) for a in range(0, 18, 2)]
    texts += ["\n".join([*CLEAN[:20], *JUNK]), "\n".join(CLEAN * 2), " A B\u0085", "Home | About | News", None, "É | é | ñ\u0085"]
    rows = [(k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.coalesce(1).write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    want = {r[0]: r[1:] for r in con.execute(f"WITH {quality_rules.oracle_ctes()} SELECT doc_id, kept, clean_text, n_repeat_words, word_chars FROM judged").fetchall()}
    got = {r["doc_id"]: tuple(r)[1:] for r in quality_rules.judge(df).select(
        "doc_id", "judged.kept", "judged.clean_text", "judged.n_repeat_words", "judged.word_chars").collect()}
    assert {k: v for k, v in got.items() if v != want[k]} == {}


def test_columns_with_any_name_stay(spark):
    good = "\n".join(CLEAN[:20]) + "\nHome | About | News"
    names = ["doc_id", "text", "judged", "n_chars", "JUDGED2", "_judged", "clean_text", "kept"]
    df = spark.createDataFrame([(1, good, "a", 7, "b", "c", "d", False), (2, "too short", "a", 7, "b", "c", "d", True), (None, None, None, None, None, None, None, None)],
                               "doc_id long, text string, judged string, n_chars long, JUDGED2 string, _judged string, clean_text string, kept boolean")
    rows = quality_rules.clean(df).collect()
    assert len(rows) == 1 and rows[0].__fields__ == names
    assert rows[0]["judged"] == "a" and rows[0]["_judged"] == "c" and rows[0]["kept"] is False and rows[0]["n_chars"] == len(rows[0]["text"])
    assert "About" not in rows[0]["text"]
