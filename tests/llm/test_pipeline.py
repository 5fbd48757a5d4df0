import corpus_pipeline as C

from lexgrid.llm import queries

from .helpers import docs, written
from .test_packing import check
from .test_simhash import plain_components, plain_fingerprint
from .test_substrings import brute


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"pipeline", *queries.queries()} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 11))
    assert [n for n, _ in C.STAGES] == ["language ID", "SimHash near-dedup", "suffix-array dedup", "packing"]


def test_stages_against_brute_force(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet").collect()
    kept = C.identify(spark, spark.createDataFrame(table), sf)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in table if any(c.isalpha() for c in r.text))
    rows = sorted(kept.collect(), key=lambda r: r.doc_id)
    unique = C.near_dedup(spark, kept, sf)
    root = plain_components([plain_fingerprint(r.text) for r in rows])
    assert sorted(r.doc_id for r in unique.collect()) == sorted({rows[k].doc_id for k in root})
    rows = unique.collect()
    cut = C.cut_repeats(spark, unique, sf)
    assert cut.columns == kept.columns
    expected = {r.doc_id: b[3].decode("utf-8", "ignore") for r, b in zip(rows, brute([(r.doc_id, r.text) for r in rows]), strict=True) if not b[1] or b[3]}
    got = cut.collect()
    assert {r.doc_id: r.text for r in got} == expected
    assert all(r.n_chars == len(r.text) for r in got)
    check(C.fill(spark, cut, sf).collect(), expected)


def test_run(spark, sf):
    assert C.run(spark, sf).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_edges(spark, tmp_path):
    same = "the quick brown fox jumps over the lazy dog and runs away from it again"
    rows = [(1, None), (2, ""), (3, "123 456"), (4, same, "en"), (4, same, "en"), (5, same, "en"), (None, same, "en"), (6, same.upper() + " und mehr " * 50, "de"), (None, "alone in the world", None), (None, "alone in the world", None)]
    table = docs(spark, rows)
    kept = C.identify(spark, table, "")
    assert kept.columns == table.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["4", "4", "5", "6", "None", "None", "None"]
    unique = C.near_dedup(spark, kept, "")
    assert unique.columns == table.columns and sorted(str(r.doc_id) for r in unique.collect()) == ["4", "6", "None"]
    assert C.cut_repeats(spark, table, "").columns == table.columns
    for stage in (C.identify, C.near_dedup, C.cut_repeats, C.fill):
        assert stage(spark, docs(spark, []), "").count() == 0
    assert C.run(spark, written(spark, table, tmp_path)).count() == 3


def test_texts_of_no_learned_language_go(spark):
    """Planted: unlearned scripts and languages, and gibberish. All documents of the table that have a letter stay."""
    import random

    from pyspark.sql import functions as F

    rng = random.Random(1)
    gibberish = lambda n, letters: " ".join("".join(rng.choices(letters, k=rng.randint(3, 9))) for _ in range(n))
    alien = [
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
        "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler.",
        "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。",
        *[gibberish(n, "abcdefghijklmnopqrstuvwxyz") for n in (50, 500)],
        *[gibberish(n, "абвгдежзийклмнопрстуфхцчшщыэюя") for n in (10, 500)],
    ]
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    planted = spark.createDataFrame([(10**9 + i, x, None, "s", len(x)) for i, x in enumerate(alien)], table.schema)
    kept = {r.doc_id for r in C.identify(spark, table.unionByName(planted), "").select("doc_id").collect()}
    assert kept == {r.doc_id for r in table.where(F.col("text").rlike("\\p{L}")).select("doc_id").collect()}


def test_near_dedup_of_shared_ids(spark):
    """Unlike texts that share a doc_id are documents of their own groups."""
    a, b, c = (" ".join(f"{w}{i}" for i in range(60)) for w in ("alpha", "beta", "gamma"))
    rows = [(5, a), (5, b), (5, b), (7, b), (8, c), (8, a), (None, c), (None, "delta " * 50)]
    got = sorted(((str(r.doc_id), r.text) for r in C.near_dedup(spark, docs(spark, rows), "").collect()))
    assert got == sorted([("5", a), ("5", b), ("8", c), ("None", "delta " * 50)])
