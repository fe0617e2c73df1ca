"""The corpus pipeline, stage by stage, against brute force."""

import hashlib
import sys
import zlib
from collections import Counter
from pathlib import Path

import public_tokenizers as P
import tiktoken
from test_dedup import classes, normal, slow_fingerprint

import corpus_pipeline
from ringtrail.llm import byte_bpe, language_id, mixing
from ringtrail.llm.common import prepare, table

from ringtrail.session import ensure_scratch
from ringtrail.staging import Staging

SMALL = "/root/testdata/sf0.001"



def test_every_stage_equals_brute_force(spark, tmp_path):
    rows = [tuple(r) for r in table(spark, SMALL, "documents").collect()]
    top = max(r[0] for r in rows)
    schema = table(spark, SMALL, "documents").schema
    odd = [None, "", " \n", "123 !", "only one copy of this", "only  one copy\tof this", "word " * 30_000]
    rows += [(top + 1 + k, t, None, None, 0) for k, t in enumerate(odd)] + [(None, "no id at all", None, "s", None), rows[0]]
    # Labels that say another language than the text.
    told = [r for r in rows if r[2] and len(r[1] or "") > 400][:12]
    unlearned = [i for i in range(top + 100, top + 400) if zlib.crc32(str(i).encode()) % 4 == 2]
    wrong = {i: {"en": "fr", "fr": "de", "de": "es", "es": "en"}[r[2]] for i, r in zip(unlearned, told, strict=False)}
    rows += [(i, f"{r[1]} {i}", wrong[i], r[3], r[4]) for i, r in zip(wrong, told, strict=True)]
    folder = str(tmp_path)
    ensure_scratch(spark)
    prepare(spark)
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    docs, kept = table(spark, folder, "documents"), rows

    steps = dict(corpus_pipeline.STAGES)
    for name in list(steps)[:4]:
        out = steps[name](spark, docs, folder)
        assert out.schema.names == docs.schema.names
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if name == "language_id":
            found = language_id.identify(table(spark, folder, "documents"), language_id.learn(table(spark, folder, "documents")))
            other = {r["doc_id"]: r["lang_pred"] for r in found.collect() if r["score"] >= language_id.CERTAIN}
            kept = [r for r in kept if any(c.isalpha() for c in r[1] or "") and (r[2] is None or other.get(r[0], r[2]) == r[2])]
            assert not {r[0] for r in kept} & set(wrong) and len(kept) > 0.95 * (len(rows) - len(wrong) - 4)
        elif name == "exact_dedup":
            groups = {}
            for r in kept:
                key = normal(r[1])
                groups[key] = min(groups.get(key, r), r, key=lambda r: (r[0] is None, r[0] or 0))
            kept = list(groups.values())
        elif name == "simhash":
            prints = [int(slow_fingerprint(r[1])) for r in kept]
            near = [(a, b) for a in range(len(kept)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
            groups = {}
            for r, c in zip(kept, classes(len(kept), near), strict=True):
                groups[c] = min(groups.get(c, r), r, key=lambda r: (r[0] is None, r[0] or 0))
            kept = list(groups.values())
        else:
            times = Counter(r["doc_id"] for r in docs.collect())
            mixed = mixing.mix(spark.read.parquet(f"{folder}/simhash"), Staging(spark, f"{folder}/mixed")).collect()
            assert times == Counter({r["doc_id"]: r["copies"] for r in mixed if r["copies"]})
            assert set(times) <= {r[0] for r in kept} and max(times.values()) <= 2
            continue
        assert sorted(repr((r["doc_id"], r["text"])) for r in docs.collect()) == sorted(repr((r[0], r[1])) for r in kept), name

    coder = tiktoken.Encoding(
        "own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={}
    )
    want = Counter()
    for r in docs.collect():
        ids = coder.encode_ordinary(r["text"] or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want[repr((r["doc_id"], len(ids), digest, hashlib.sha256((r["text"] or "").encode()).hexdigest()))] += 1
    assert Counter(repr(tuple(r)) for r in steps["byte_bpe"](spark, docs, folder).collect()) == want
    assert Counter(repr(tuple(r)) for r in corpus_pipeline.run(spark, folder).collect()) == want


def test_no_documents(spark, tmp_path):
    table(spark, SMALL, "documents").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_the_library_does_not_import_it():
    root = Path(sys.modules["ringtrail"].__file__).parent
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert "ringtrail.llm" not in path.read_text(), path
