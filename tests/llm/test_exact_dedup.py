import hashlib
import random
import re

import pytest

from sitewise.llm.exact_dedup import exact_groups

SCHEMA = "doc_id long, text string"


def expected(rows):
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = {}
    for (i, _), t in zip(rows, normal, strict=True):
        groups.setdefault(t, []).append(i)
    out = []
    for (i, _), t in zip(rows, normal, strict=True):
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hash_all", [True, False])
def test_brute_force(spark, hash_all):
    r = random.Random(1)
    texts = ["".join(r.choice("ab \n\té") for _ in range(r.choice([1, 3, 6, 200]))) for _ in range(300)]
    texts += ["p" * 128 + x for x in ("a", "b", "a", "c" * 9, "d" * 9)] + ["x" * 200_000, "x" * 200_000, None, "", " ", "\n\n", None]
    rows = [(i, t) for i, t in enumerate(texts, start=10)] + [(10, texts[0]), (None, "a b"), (None, "only here"), (None, "only here")]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as n", "2 as p", "'x' as keep_id", "true as maybe")
    got = exact_groups(df, hash_all=hash_all).collect()
    want = expected(rows)
    assert sorted(((x.doc_id, x.keep_id, x.group_size, x.kept) for x in got), key=repr) == sorted((w[:4] for w in want), key=repr)
    if hash_all:
        assert sorted(map(tuple, got), key=repr) == want
    else:  # only groups of several rows had to be hashed, and all of them were
        assert all(x.text_sha256 is not None for x in got if x.group_size > 1) and sum(x.text_sha256 is None for x in got) > 20


def test_empty(spark):
    assert exact_groups(spark.createDataFrame([], SCHEMA), hash_all=True).collect() == []
