"""The whole pipeline against a brute-force version of every stage; odd rows; optional folder."""

import hashlib
import re
import subprocess
import sys

import duckdb
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from fichario.llm import pii, quality_rules
from tests.llm.test_pii import slow as slow_spans
from tests.llm.test_simhash import slow_components, slow_fingerprint

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def windows(text):
    words = re.findall(r"[^\W\d_]+", text.lower())
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def test_whole_pipeline_against_brute_force(spark):
    db = duckdb.connect()
    for name in ("documents", "labels"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    kept = {i for (i,) in db.execute(f"SELECT doc_id FROM ({quality_rules.SQL}) WHERE kept").fetchall()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect() if r.doc_id in kept}
    names = slow_components({i: slow_fingerprint(t) for i, t in texts.items()})
    texts = {i: t for i, t in texts.items() if names[i] == i}
    items = [w for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect() if (w := windows(r.text))]
    texts = {i: t for i, t in texts.items() if not any(len(w & windows(t)) >= 0.8 * len(w) for w in items)}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for i, text in texts.items():
        masked = pii.masked(text, ",".join(slow_spans(text)))
        ids = np.array(library.encode(masked, add_special_tokens=False).ids, "<u4")
        want[i] = (len(masked), len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id: (r.n_chars, r.n_tokens, r.ids_sha256) for r in rows} == want
    assert len(rows) == len(want) and 0 < len(want) < 200


def test_every_stage_takes_odd_rows(spark):
    prose = " ".join(f"plain{n} word" for n in range(30))
    rows = [(1, prose, "en", "s", 1), (1, prose, "en", "s", 1), (None, prose + " end", None, None, None),
            (2, None, "en", None, 0), (3, "", None, "s", 0), (4, "long text here " * 20_000, "de", "s", 5),
            (5, prose + " write to a@b.cd", "en", "s", 9)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, FOLDER)
            if name != "bpe":
                assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
            count = out.count()
            assert count <= frame.count() and (count > 0 or frame is not docs)
    masked = {r.doc_id: r.text for r in corpus_pipeline.personal_data(spark, docs, FOLDER).collect()}
    assert masked[5] == prose + " write to [EMAIL]" and masked[2] is None


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "simhash_near_dedup", "benchmark_decontamination", "pii", "bpe"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_the_rest_works_without_the_folder():
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'fichario.llm': raise ModuleNotFoundError(name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "names = list(e.queries())\n"
        "assert names and not any(n.startswith('op') and n[2].isdigit() for n in names) and 'pipeline' not in names\n")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=60)
