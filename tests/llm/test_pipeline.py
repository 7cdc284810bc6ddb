"""The pipeline, stage by stage, against plain versions; and the library without it."""

import subprocess
import sys
import zlib
from collections import Counter

import corpus_pipeline
from tallyhouse.llm import quality
from tallyhouse.llm.common import keep, table
from tests.llm.conftest import ODD, ROOT
from tests.llm.test_texts import counts, plain_groups, plain_simhash
from tests.llm.test_tokens import check_pieces


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(keep(stage(spark, kept[-1], sf_dir), name))
        assert kept[-1].columns == docs.columns
    rows = [{r.doc_id: r for r in x.collect()} for x in kept]
    good = {r.doc_id for r in quality.classify(docs, table(spark, sf_dir, "labels")).collect() if r.predicted}
    assert rows[1] == {i: r for i, r in rows[0].items() if i in good}
    assert set(rows[2]) <= {i for i, r in rows[1].items() if not counts(r.text)[5]}
    known = {r.doc_id: r.quality for r in table(spark, sf_dir, "labels").collect()}
    clean = {i for i, r in rows[0].items() if known.get(i) == 1 and not counts(r.text)[5]}
    assert clean <= set(rows[2]) and all(r.n_chars == len(r.text) for r in rows[2].values())
    prints = {i: plain_simhash(r.text) for i, r in rows[2].items()}
    group, least = plain_groups(prints.values()), {}
    for i, f in prints.items():
        least[group[f]] = min(i, least.get(group[f], i))
    assert rows[3] == {i: rows[2][i] for i in least.values()}
    pieces = [r.asDict() for r in corpus_pipeline.run(spark, sf_dir).collect()]
    check_pieces(pieces, {i: r.text for i, r in rows[3].items()}, 2048)


def test_odd_documents(spark, odd, nothing, sf_dir):
    for docs in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == odd.columns and out.dtypes == odd.dtypes
            assert Counter(r.doc_id for r in out.collect()) <= Counter(i for i, _ in ODD)
    assert corpus_pipeline.STAGES[-1][1](spark, nothing, sf_dir).count() == 0


def test_rest_imports_without_this_part():
    code = "import sys\nsys.modules['tallyhouse.llm'] = None\nimport __spark_entry__ as e\nassert e.queries() and not [q for q in e.queries() if q.startswith('op1')]"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=False).returncode == 0
    assert zlib.crc32(b"0") % 5 in range(5)
