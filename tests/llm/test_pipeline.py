import json
import subprocess
import sys

import pytest

import corpus_pipeline as P
from shelfmark.llm import token_files
from shelfmark.llm.common import table
from shelfmark.session import stash
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    names = docs.columns
    kept = {}
    for name, stage in P.STAGES:
        docs = stash(stage(spark, docs, SF))
        kept[name] = docs
        if name != "tokens":
            assert docs.columns == names
    ids = lambda k: {r["doc_id"] for r in kept[k].select("doc_id").collect()}
    rows = {r["doc_id"]: r["text"] for r in kept["quality"].collect()}
    groups = brute.components(sorted((d, brute.simhash(t)) for d, t in rows.items()))
    assert ids("near-dedup") == set(groups.values())
    bench = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
    hit = {r[0] for r in brute.decontam([(d, rows[d]) for d in ids("near-dedup")], bench) if r[5]}
    assert ids("decontamination") == ids("near-dedup") - hit
    assert ids("mixing") <= ids("decontamination")
    assert kept["tokens"].count() == kept["mixing"].count()
    assert P.run(spark, SF).count() == kept["tokens"].count()


READ = """
import sys, json
from shelfmark.llm import token_files as T
import pyarrow.fs
folder = sys.argv[1]
m = T._manifest(folder)
fs, base = pyarrow.fs.FileSystem.from_uri(folder)
out = []
for part, sub in zip(m["part"].tolist(), m["sub"].tolist()):
    shard = T.Shard(fs, f"{base}/{T._name(part, sub)}").load()
    out += [(int(shard.ids[r]), shard.tokens(r).tolist()) for r in range(len(shard.ids))]
print(json.dumps(out))
"""


def test_token_files_stay_and_another_process_reads_them(spark, tmp_path):
    out = f"file://{tmp_path}/tokens"
    rows = P.run(spark, SF, out)
    assert {r["shard"].rpartition("/")[0] for r in rows.collect()} == {out}
    found = json.loads(subprocess.run([sys.executable, "-c", READ, out], capture_output=True, check=True, cwd=".").stdout)
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(token_files.tokenizer_path())
    assert found == [[d, [*tk.encode(texts[d], add_special_tokens=False).ids, 0]] for d, _ in found] and found == sorted(found)
    assert len(found) == rows.count() > 0
    with pytest.raises(ValueError, match="holds files"):
        P.token_stage(spark, table(spark, SF, "documents"), SF, out)


def test_empty_corpus(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in P.STAGES:
        docs = stash(stage(spark, docs, SF))
        assert docs.count() == 0


def test_stages_keep_columns_that_clash(spark, docs):
    rows = docs
    for name, stage in P.STAGES[:-1]:
        rows = stash(stage(spark, rows, SF))
        assert rows.columns == docs.columns, name
    assert P.token_stage(spark, rows, SF).count() == rows.count()
