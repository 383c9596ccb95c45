import os
import re
import subprocess
import sys
from collections import Counter, defaultdict

import corpus_pipeline as cp
from ledgerlake.llm import langid
from ledgerlake.session import scratch_path
from tests.conftest import SF_SMALL
from tests.llm import test_repair
from tests.llm.helpers import docs, edge_docs, empty_docs
from tests.llm.test_mixture import WORD, brute_targets
from tests.llm.test_setsketch import brute as brute_groups


def staged(spark, df, sf=SF_SMALL):
    """The table after each stage, written and reread as the driver does."""
    out = [df]
    for name, stage in cp.STAGES:
        path = scratch_path(spark, f"test-{name}")
        stage(spark, out[-1], sf).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_every_stage_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    start, lang, near, clean, mixed, tokens = staged(spark, docs(spark, sf), sf)
    rows = lambda df: {r["doc_id"]: r for r in df.collect()}
    a, b, c, d = rows(start), rows(lang), rows(near), rows(clean)
    model = langid.train(start.where(~langid.held_out(start["doc_id"], 4, 2)))
    scores = {r["doc_id"]: r for r in langid.predict(start, model).collect()}
    assert b.keys() == {i for i, r in scores.items() if r["lang_pred"] != "und" and r["score"] >= 0.5}
    assert len(b) > 0.98 * len(a)
    assert c.keys() == {i for i, _, g in brute_groups([(i, r["text"]) for i, r in b.items()], 5) if i == g}
    flat = lambda t: " " + " ".join(re.findall(r"[a-z0-9\u0080-\U0010ffff]+", t.lower())) + " "
    items = [flat(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert d.keys() == {i for i, r in c.items() if not any(x in flat(r["text"]) for x in items)}
    assert len(d) < len(c) < len(b)
    taken = mixed.collect()
    sizes, got, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in d.values():
        n = len(WORD.findall(r["text"]))
        sizes[r["source"]] += n
        largest[r["source"]] = max(largest[r["source"]], n)
    for r in taken:
        assert r == d[r["doc_id"]]
        got[r["source"]] += len(WORD.findall(r["text"]))
    assert max(Counter(r["doc_id"] for r in taken).values()) <= 2
    for s, t in brute_targets(sizes).items():
        assert abs(got[s] - t) <= largest[s]
    assert sorted(map(tuple, tokens.collect())) == sorted(test_repair.expected([(r["doc_id"], r["text"]) for r in taken]))
    for df in (lang, near, clean, mixed):
        assert df.schema.simpleString() == start.schema.simpleString()


def test_run_equals_the_stages(spark):
    got = sorted(map(tuple, cp.run(spark, SF_SMALL).collect()))
    assert got == sorted(map(tuple, staged(spark, docs(spark))[-1].collect()))


def test_edge_rows_and_empty_table(spark):
    out = staged(spark, edge_docs(spark))
    for df in out[:-1]:
        assert df.columns == edge_docs(spark).columns
    assert {r["doc_id"] for r in out[1].collect()} >= {4, 7, 8}
    assert all(df.count() == 0 for df in staged(spark, empty_docs(spark)))


#: Page faults of scoring a slice of letters and of a block's grammar, once
#: warm, and MB that stay when 100 MB of larger arrays are freed.
WORKER = """
import resource
import numpy as np
import corpus_pipeline as cp
from ledgerlake.llm import langid, repair

faults = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_minflt
resident = lambda: int(open("/proc/self/statm").read().split()[1]) * resource.getpagesize() >> 20
rng = np.random.default_rng(1)
ids = rng.integers(0, 3000, (5000, 4))[rng.integers(0, 5000, 1 << 17)].ravel().astype(np.uint32)
code = rng.choice(np.array([32, 97, 98, 99], np.uint32), cp.LETTERS_SLICE)
model = langid.Model(["a", "b"], np.zeros((2, langid.BUCKETS), np.float32), np.zeros(2))
for work in (lambda: langid.score(model, code, np.array([0, len(code)])), lambda: repair.pack_block(ids, 3000)):
    work()
    before = faults()
    work()
    print(faults() - before)
before = resident()
held = [np.ones(1 << 20) for _ in range(12)]
del held
print(resident() - before)
"""


def test_workers_keep_their_pages_and_give_large_arrays_back():
    out = subprocess.run([sys.executable, "-c", WORKER], check=True, capture_output=True, text=True, timeout=120,
                         env={**os.environ, **cp.WORKER_MEMORY, "PYTHONPATH": os.path.dirname(cp.__file__)})
    scored, packed, kept = map(int, out.stdout.split())
    assert scored < 3000 and packed < 20000 and kept < 20
