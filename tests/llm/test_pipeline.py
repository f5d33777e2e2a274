import random
import re
from collections import Counter

import corpus_pipeline as C
from sitewise.llm import toxicity as T
from tests.llm import brute
from tests.llm.test_packing import check

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark, path):
    r = random.Random(7)
    words = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
    docs, labels = [], []
    for i in range(260):
        w = [r.choice(words) for _ in range(r.randrange(30, 60))]
        toxic = i % 6 == 0
        if toxic:
            w[5:5] = ["scumbag", "idiotic", "scumbag"]
        docs.append((i, " ".join(w)))
        labels.append((i, int(i % 5 != 0), int(toxic)))
    docs += [(300 + i, docs[i][1].replace(" ", "  ", 1)) for i in range(20)] + [(400 + i, docs[20 + i][1] + " extra") for i in range(20)]
    docs += [(500, None), (501, ""), (502, "word " * 5000), (None, "a row without an id")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS)
    df.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return df


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def distinct(rows):
    best = {}
    for i, t in rows:
        old = best.get(normal(t))
        if old is None or (i is None, i or 0) < (old[0] is None, old[0] or 0):
            best[normal(t)] = (i, t)
    return list(best.values())


def one_each(rows):
    keyed = sorted(rows, key=lambda x: (x[0] is None, x[0] or 0))
    want = brute.jaccard([(k, t) for k, (_, t) in enumerate(keyed)])
    return [x for k, x in enumerate(keyed) if want[k][1] == k]


def test_rows_go_not_ids(spark, tmp_path):
    base = [" ".join(f"w{7 * i + j}" for j in range(30)) for i in range(6)]
    rows = [(1, base[0]), (5, base[0]), (5, base[1]), (5, base[1]), (None, base[2]), (None, base[2]), (7, base[2] + "  "), (None, base[3]), (8, None), (9, ""), (9, base[4] + " x"), (3, base[4])]
    extra = "doc_id long, text string, row int, maybe int, bitmap_piece int, bitmap_bits int, shared int, n int, key int, rate int, cell int, mix_words int, p int"
    names = [c.split()[0] for c in extra.split(", ")]
    df = spark.createDataFrame([(*r, *[k] * (len(names) - 2)) for k, r in enumerate(rows)], extra)
    labels = f"{tmp_path}/labels.parquet"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(labels)
    pairs = lambda d: [(x.doc_id, normal(x.text).strip()) for x in d.collect()]
    clean = [(i, normal(t).strip()) for i, t in rows]
    exact = C.exact_dedup(spark, df, str(tmp_path))
    assert exact.columns == names and Counter(i for i, _ in pairs(exact)) == Counter(i for i, _ in distinct(rows))
    near = C.near_dedup(spark, df, str(tmp_path))
    want = one_each(clean)
    assert near.columns == names and Counter(t for _, t in pairs(near)) == Counter(t for _, t in want) and Counter(i for i, _ in pairs(near)) == Counter(i for i, _ in want)
    assert {i for i, t in pairs(near) if t == base[1]} == {5}
    out = C.mixing(spark, df, str(tmp_path))
    assert out.columns == names and out.count() >= len(rows)
    assert C.toxicity(spark, df, str(tmp_path)).columns == names


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


def test_stages(spark, tmp_path):
    path = str(tmp_path)
    docs = tables(spark, path)
    rows = lambda df: [(x.doc_id, x.text) for x in df.collect()]
    model = T.fit_on(docs, spark.read.parquet(f"{path}/labels.parquet"))
    at = {}
    for name, stage in C.STAGES:
        out = stage(spark, docs, path)
        before, after = rows(docs) if "text" in docs.columns else None, None
        if name != "best-fit packing":
            assert out.columns == docs.columns
            after = rows(out)
        if name == "toxicity":
            assert Counter(after) == Counter((i, t) for i, t in before if model.score(t or "") < T.THRESHOLD)
            gone = {i for i, _ in before} - {i for i, _ in after}
            assert all(i % 6 == 0 for i in gone if i is not None and i < 260) and len(gone) > 35
        elif name == "exact dedup":
            assert Counter(after) == Counter(distinct(before)) and not any(i is not None and 300 <= i < 320 and i - 300 in dict(after) for i, _ in after)
        elif name == "n-gram Jaccard join":
            assert Counter(after) == Counter(one_each(before))
        elif name.startswith("mixing"):
            assert set(after) == set(before) and len(after) >= len(before)
        else:
            check(out.collect(), before, 1024)
        docs = spark.createDataFrame(out.collect(), out.schema)
        at[name] = docs.count()
    assert at["exact dedup"] < at["toxicity"] and at["n-gram Jaccard join"] < at["exact dedup"]


def test_run_gives_the_last_stage(spark, tmp_path):
    tables(spark, str(tmp_path))
    out = C.run(spark, str(tmp_path))
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} == set(out.columns) and out.count() > 150
