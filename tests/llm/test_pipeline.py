import hashlib

import corpus_pipeline
import public_tokenizers
import tiktoken

from ledgerflow.llm import bpe, core, mixing, weak_labels

from .helpers import awkward_texts, table
from .test_jaccard import brute, family


def test_stages_on_awkward_rows(spark, monkeypatch):
    core.ship(spark)
    texts = awkward_texts() + family(5, 30)
    docs = table(spark, texts)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = core.write_stage(stage(spark, docs, ""), name)
        seen[name] = docs
        if name != "tokens":
            assert docs.columns == before.columns, name

    rows = {n: {r.doc_id: r for r in d.collect()} for n, d in seen.items()}
    model = weak_labels.train(table(spark, texts))
    assert set(rows["quality"]) == {r.doc_id for r in weak_labels.score(table(spark, texts), model).collect() if r.keep}

    ids = sorted(rows["quality"])
    groups = brute([texts[i] for i in ids], ids, corpus_pipeline.SHINGLE, corpus_pipeline.SIMILARITY)
    assert set(rows["near_duplicates"]) == {i for i in ids if groups[i][1] == i}

    strings = set()
    for i in sorted(rows["near_duplicates"]):
        b = texts[i].encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 99):
            if b[k:k + 100] in strings:
                gone[k:k + 100] = b"\1" * 100
            strings.add(b[k:k + 100])
        kept = bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore")
        assert (rows["repeated_strings"][i].text if i in rows["repeated_strings"] else "") == kept
        assert not kept or rows["repeated_strings"][i].n_chars == len(kept)

    keyed = mixing.keyed(seen["repeated_strings"], "doc_id", "source", "text")
    copies = {r.id: r.copies for r in mixing.copies(keyed, mixing.plan(keyed)).collect()}
    assert sum(copies.values()) == seen["mixture"].count() == seen["tokens"].count()
    assert set(rows["mixture"]) == set(rows["repeated_strings"])

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(f.read()), special_tokens={})
    for i, r in rows["tokens"].items():
        text = rows["mixture"][i].text
        ids = [int.from_bytes(r.token_ids[k:k + 4], "little") for k in range(0, len(r.token_ids), 4)]
        assert ids == library.encode_ordinary(text) and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_empty_documents(spark):
    core.ship(spark)
    docs = table(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        docs = core.write_stage(stage(spark, docs, ""), name)
        assert docs.count() == 0
