import os
import random
from collections import Counter
from difflib import SequenceMatcher

import duckdb
import numpy as np
import pytest

from confluo.functions import pairwise, similarity
from confluo.operators import resolution
from confluo.plans import registry

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def some_texts():
    rng = random.Random(5)
    texts = {"", "x" * 64, "y" * 65, "x" * 63 + "b", "b" + "x" * 63, "ab" * 110, "qzw", "only ẞ here", "\U0001f600a"}
    while len(texts) < 120:
        letters = "abcdeé\U0001f600 ß"[: rng.choice([2, 4, 9])]
        texts.add("".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 5, 9, 30, 63, 64, 66]))))
    texts = sorted(texts)
    return texts, *(np.array(x) for x in zip(*[(a, b) for a in range(120) for b in range(120)]))


def test_many_names_at_once_equal_one_by_one():
    texts, a, b = some_texts()
    t = pairwise.Texts(texts)
    edits, winkler = pairwise.edit_share(t, a, b), similarity.jaro_winklers(t, a, b)
    for x, y, e, w in zip(a, b, edits, winkler):
        x, y = texts[x], texts[y]
        n = max(len(x), len(y))
        assert e == (pairwise.half_up(max(0.0, 1.0 - pairwise._plain_edits(x, y) / n), 8) if n else 1.0)
        assert w == pairwise.half_up(round(similarity._jaro_winkler(x, y), 8), 4)


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    """The table with a hot email, ids in two systems, and an equal name of letters that no other has."""
    folder = tmp_path_factory.mktemp("odd")
    con = duckdb.connect()
    con.execute(f"create table t as select dense_rank() over (order by source_customer_id) n, * from '{SF}/silver_customer.parquet'")
    con.execute("update t set email = 'all@one.example' where n % 3 = 0")
    con.execute("update t set company_name = 'ØÆ ÅÇÑ' where n in (3, 6)")
    con.execute("insert into t by name select * replace ('OTHER' as source_system, 'Twin ' || company_name as company_name) from t where n % 23 = 0")
    con.execute(f"copy (select * exclude (n) from t) to '{folder}/silver_customer.parquet' (format parquet)")
    con.execute(f"create view silver_customer as select * from '{folder}/silver_customer.parquet'")
    return str(folder), con


def same(spark, name, folder, con):
    df, c = registry.QUERIES[name](spark, folder), con.execute(registry.ORACLE[name])
    names = [d[0] for d in c.description]
    norm = lambda v: f"{float(v):.8g}" if isinstance(v, (int, float)) else str(v)
    got, want = (Counter(tuple(map(norm, r)) for r in x) for x in (df.select(*names).collect(), c.fetchall()))
    assert got == want and want


def no_join_over_pairs(df):
    """Pairs are neither shuffled nor scored by a function for each: rows of blocks go in, scored pairs come out."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "EvalPython" not in plan and plan.index("MapInArrow") < plan.index("Exchange")


@tables
@pytest.mark.parametrize("part_rows", [7, 512])
def test_pair_similarities_equal_sql(spark, odd, monkeypatch, part_rows):
    monkeypatch.setattr(resolution.scored_pairs, "__defaults__", (part_rows,))
    monkeypatch.setattr(resolution, "PAIRS_AT_ONCE", 500)
    same(spark, "pair_similarities", *odd)
    assert no_join_over_pairs(registry.QUERIES["pair_similarities"](spark, SF))


def test_many_common_blocks_equal_one_by_one():
    texts, a, b = some_texts()
    for x, y, ratio in zip(a, b, pairwise.sequence_ratio(pairwise.Texts(texts), a, b)):
        assert ratio == round(SequenceMatcher(None, texts[x], texts[y]).ratio(), 8)


@tables
def test_pair_seq_ratio_of_all_pairs(spark, odd):
    folder, con = odd
    at = registry.ORACLE["pair_similarities"]
    names = con.execute(at[: at.rindex("select p.")] + 'select p."left", p."right", l.company_name, r.company_name from pairs p join rows_ l on l.id = p."left" join rows_ r on r.id = p."right"').fetchall()
    want = Counter((p, q, None if x is None or y is None else round(SequenceMatcher(None, x, y).ratio(), 8)) for p, q, x, y in names)
    assert Counter(tuple(r) for r in registry.QUERIES["pair_seq_ratio"](spark, folder).collect()) == want
    assert no_join_over_pairs(registry.QUERIES["pair_seq_ratio"](spark, SF))


@tables
def test_clusters_equal_sql(spark, odd, monkeypatch):
    called = []
    levenshtein = resolution.pair_scores
    monkeypatch.setattr(resolution, "pair_scores", lambda pairs, rows: called.append(pairs.count()) or levenshtein(pairs, rows))
    same(spark, "clusters", *odd)
    assert registry.QUERIES["clusters"](spark, SF).count()
    assert called[1] < registry.QUERIES["candidate_pairs"](spark, SF).count() / 2  # of most pairs no edits are counted in the JVM
