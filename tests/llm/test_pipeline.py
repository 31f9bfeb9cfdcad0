"""The pipeline against a plain version of its stages."""

import hashlib
import re

import corpus_pipeline
import public_tokenizers
import tiktoken
from compare import DATA
from test_minhash_dedup import brute as near_brute
from test_mixing import plain_mix

from fernweave.llm import bpe, quality_rules


def plain(spark, documents):
    kept = [d for d in documents if not any(r.rejects(quality_rules.Measures(d["text"])) for r in quality_rules.RULES)]
    own = {k for k, _, _, keep in near_brute([(d["doc_id"], d["text"]) for d in kept], 80) if keep}
    kept = [d for d in kept if d["doc_id"] in own]
    taken = plain_mix(spark, [(d["doc_id"], d["source"], d["text"]) for d in kept])
    texts = []
    for d, times_of in zip(kept, taken, strict=True):
        words = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", d["text"])]
        for k in (1, 2):
            parts = []
            for w, times in enumerate(times_of):
                if times >= k:
                    if parts and parts[-1][1] == w:
                        parts[-1][1] = w + 1
                    else:
                        parts.append([w, w + 1])
            if parts == [[0, len(words)]]:
                texts.append((d["doc_id"], d["text"]))
            elif parts:
                texts.append((d["doc_id"], "\n".join(d["text"][words[a][0] : words[z - 1][1]] for a, z in parts)))
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    out = []
    for k, t in texts:
        ids = encoding.encode_ordinary(t)
        out.append((k, len(t), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out)


def test_run_equals_plain_stages(spark):
    rows = corpus_pipeline.run(spark, DATA).collect()
    got = sorted((r["doc_id"], r["n_chars"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows)
    documents = [r.asDict() for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert got == plain(spark, documents) and got


def test_stages_keep_the_columns(spark, folder, odd_documents):
    docs = spark.read.parquet(folder(documents=odd_documents) + "/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == len(odd_documents)


def test_empty_table(spark, folder):
    assert corpus_pipeline.run(spark, folder(documents=[])).count() == 0
