"""FIXTURES.md section 4: normalisation and pre-tokenisation edge strings."""

from pyspark.sql import functions as F

from twinline.functions import text as tx


def _words(spark, s):
    return spark.createDataFrame([(s,)], "t string").select(tx.words(F.col("t")).alias("w")).first()["w"]


def test_pre_tokenize(spark):
    s = "l'été n'est-il pas_ici?! 3,5 café Ⓐ Ⅻ ½ x²"
    assert _words(spark, s) == ["l", "'", "été", "n", "'", "est", "-", "il", "pas_ici", "?!", "3", ",", "5",
                                "café", "ⓐ", "ⅻ", "½", "x", "²"]


def test_zero_width_joiner(spark):
    assert _words(spark, "a‍b c") == ["a‍b", "c"]


def test_nfc_then_lowercase(spark):
    assert _words(spark, "ÉCOLE") == ["école"]


def test_no_final_sigma(spark):
    assert _words(spark, "ΌΔΟΣ") == ["όδοσ"]


def test_dotted_capital_i(spark):
    assert _words(spark, "İ") == ["i̇"]


def test_special_in_text(spark):
    assert _words(spark, "[pad] x[PAD]y [PAD]") == ["[", "pad", "]", "x", "[PAD]", "y", "[PAD]"]
    assert _words(spark, "?[EOS]!") == ["?", "[EOS]", "!"]


def test_nfc_gate_only_sends_changeable_rows(spark):
    df = spark.createDataFrame([("café",), ("café",), ("Å",), (None,)], "t string")
    out = [r[0] for r in df.select(tx.nfc(F.col("t"))).collect()]
    assert out == ["café", "café", "Å", None]


def test_source_profile(spark):
    df = spark.createDataFrame([("Héllo, World! it's\tfine\x00.",)], "t string")
    assert df.select(tx.source_words(F.col("t"))).first()[0] == ["hello", ",", "world", "!", "it", "'", "s",
                                                                 "fine", "."]


def test_line_endings_with_spark_reader(spark, tmp_path):
    p = tmp_path / "x.txt"
    p.write_bytes(b"a\r\nb\rc\n\nd")
    rows = [r[0] for r in spark.read.text(str(p)).collect()]
    assert rows == ["a", "b", "c", "", "d"]
