"""The pipeline stage by stage, and every stated SQL statement."""

import hashlib
import os
import subprocess
import sys

import duckdb
import numpy as np
import pytest

from ..conftest import ROOT, SF_MID, SF_SMALL


def test_stages_hold_what_their_operators_say(spark, tmp_path):
    import corpus_pipeline as P
    from shardloom.llm import byte_bpe, mixing, quality_perplexity, secret_scan, simhash_dedup
    from shardloom.llm.catalog import vocabulary

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    cols, seen = docs.columns, {}
    for name, stage in P.STAGES:
        stage(spark, docs, SF_SMALL).write.parquet(str(tmp_path / name))
        seen[name] = docs
        docs = spark.read.parquet(str(tmp_path / name))
        assert name == P.STAGES[-1][0] or docs.columns == cols
        seen[name + "+"] = docs
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert ids(seen["quality_rules+"]) == ids(quality_perplexity.judge(seen["quality_rules"]).where("kept"))
    assert ids(seen["simhash_dedup+"]) == sorted({r.component_id for r in simhash_dedup.simhash_groups(seen["simhash_dedup"]).collect()})
    assert ids(seen["secret_scan+"]) == ids(seen["secret_scan"])
    assert not [r for r in secret_scan.scan(seen["secret_scan+"]).collect() if r.spans]
    plan = {r.doc_id: r.taken for r in mixing.mix_plan(seen["source_mixing"]).collect()}
    words = {}
    for r in seen["source_mixing+"].collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.encode().split())
    assert words == {i: n for i, n in plan.items() if n}
    import tiktoken
    data, pattern = vocabulary()
    enc = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=byte_bpe.load_ranks(data), special_tokens={}).encode_ordinary
    want = sorted((r.doc_id, hashlib.sha256(np.array(enc(r.text), "<u4").tobytes()).hexdigest()) for r in seen["source_mixing+"].collect())
    assert sorted((r.doc_id, r.ids_sha256) for r in docs.collect()) == want


def test_run_gives_the_last_stage(spark):
    import corpus_pipeline as P

    got = P.run(spark, SF_SMALL)
    assert got.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 0


def _sql_queries():
    from shardloom.llm.catalog import LLM_ORACLE

    return sorted(LLM_ORACLE)


@pytest.mark.parametrize("name", _sql_queries())
def test_query_equals_its_sql(spark, name):
    from shardloom.llm.catalog import LLM_ORACLE, LLM_QUERIES

    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_MID}/{t}.parquet')")
    cur = con.execute(LLM_ORACLE[name])
    names = [d[0] for d in cur.description]
    got = LLM_QUERIES[name](spark, SF_MID)
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(str, cur.fetchall())) == sorted(str(tuple(r)) for r in got.select(*names).collect())


# Queries that SQL does not state, and the test that holds each against a plain version.
PLAIN = {
    "op1_embedding_dedup": "test_embeddings.py", "op3_simhash_dedup": "test_simhash.py", "op4_quality_perplexity": "test_quality.py",
    "op5_url_rules": "test_urls.py", "op7_byte_bpe": "test_bpe.py", "op10_toxicity_fm": "test_toxicity.py", "op12_whitening": "test_whitening.py",
}


def test_every_query_is_stated_or_held_against_a_plain_version():
    from shardloom.llm.catalog import LLM_ORACLE, LLM_QUERIES

    assert set(LLM_QUERIES) == set(LLM_ORACLE) | set(PLAIN)
    assert all(os.path.exists(os.path.join(os.path.dirname(__file__), f)) for f in PLAIN.values())


def test_the_library_works_without_the_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "shardloom"):
        os.symlink(os.path.join(ROOT, name), tmp_path / name)
    code = ("import sys; sys.modules['shardloom.llm'] = None\n"
            "import __spark_entry__ as e; q = e.queries(); assert q and e.oracle_sql() and not any(k.startswith('op') or k == 'pipeline' for k in q), sorted(q)")
    env = os.environ | {"PYTHONPATH": str(tmp_path), "PYTHONDONTWRITEBYTECODE": "1"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=120)
