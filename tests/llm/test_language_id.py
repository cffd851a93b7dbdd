import zlib

from ledgerlens.llm import language_id as L
from ledgerlens.llm import queries
from llm_cases import messy, nothing  # noqa: F401


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()
    lang = {r["doc_id"]: r["lang"] for r in docs}
    rows = queries.op2_language_id(spark, sf).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) > 0.98 * len(held)


def test_odd_rows(spark, messy, nothing):
    training = spark.createDataFrame([(None, "en"), ("words of the language", None), ("", "fr")] + [
        (f"alpha beta gamma delta number {i}", "en") for i in range(5)] + [
        (f"Ünïcödé ßtraße und Öl {i}", "de") for i in range(5)], "text string, lang string")
    got = {r["doc_id"]: r for r in L.language_id(messy, training).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 and got[i]["rejected"] for i in (1, 2, 3, 9))
    assert got[4]["lang_pred"] == "en" and got[7]["lang_pred"] == "de" and got[6]["lang_pred"] in ("en", "de")
    assert L.language_id(nothing, training).collect() == []
    assert {r["lang_pred"] for r in L.language_id(messy, training.limit(0)).collect()} == {"und"}


def test_mislabelled_samples_are_left_out():
    right = [b"the cat sat on the mat and %d" % i for i in range(40)]
    other = [b"der hund lief durch das haus %d" % i for i in range(40)]
    dicts = L.dictionaries({"en": right + other[:4], "de": other}, 1 << 16)
    assert b"hund" not in dicts["en"] and b"cat" in dicts["en"]


def test_copies_do_not_push_out_a_language(spark):
    from pyspark.sql import functions as F
    copies = spark.range(2_000_000).select(F.lit("der hund lief durch das haus").alias("text"), F.lit("de").alias("lang"))
    texts = spark.range(1200).select(F.concat(F.lit("die katze und der hund nummer "), F.hex("id")).alias("text"), F.lit("de").alias("lang"))
    other = spark.range(300).select(F.concat(F.lit("the cat and the dog number "), F.hex("id")).alias("text"), F.lit("en").alias("lang"))
    sample = L.training_sample(copies.unionByName(texts).unionByName(other), 256, 2048, 64, 7)
    assert {n: len(t) for n, t in sample.items()} == {"de": 256, "en": 256}


def test_every_language_is_learnt(spark):
    import random
    rng = random.Random(3)
    words = {f"l{n:02}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(30)]
             for n in range(70)}

    def texts(each):
        return [(" ".join(rng.choice(w) for _ in range(25)), n) for n, w in words.items() for _ in range(each(n))]

    training = spark.createDataFrame(texts(lambda n: 8 if n < "l64" else 4), "text string, lang string")
    docs = spark.createDataFrame(texts(lambda n: 1), "text string, doc_id string")
    rows = L.language_id(docs, training).collect()
    assert len(rows) == 70 and all(r["lang_pred"] == r["doc_id"] for r in rows)
    sample = L.training_sample(training, 6, 2048, 35, 7)
    assert {n: len(t) for n, t in sample.items()} == dict.fromkeys(words, 3)


def test_groups_of_compressors_tell_the_same(monkeypatch):
    dicts = {n: b" ".join(b"%s%d" % (n.encode() * 3, i % 7) for i in range(90)) for n in "abcdefg"}
    norms = [b"aaa1 aaa2", b"ggg1 ggg3 fff", b"ccc eee2 eee2 eee4", b"zzz"]
    whole = L.Encoder(dicts, 6).best(norms)
    monkeypatch.setattr(L, "HELD", 2)
    assert L.Encoder(dicts, 6).best(norms) == whole
