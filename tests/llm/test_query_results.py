"""Registered queries on a given table: against their SQL, or against a plain version of what they promise."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from conftest import SF
from tokenizers import Tokenizer

from compare import compare, connect
from ledgerline.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLES[name], SF) is None


def test_packing_query(spark, documents):
    got = QUERIES["op1_packing"](spark, SF).toPandas()
    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r.doc_id: [*encoder.encode(r.text or "", add_special_tokens=False).ids, 2] for r in documents.itertuples()}
    for doc_id, pieces in got.groupby("doc_id"):
        at = 0
        for p in pieces.sort_values("start").itertuples():
            data = np.array(ids[doc_id][at : at + p.length], dtype="<u4").tobytes()
            assert (p.start, p.ids_crc32, p.doc_tokens) == (at, zlib.crc32(data), len(ids[doc_id]))
            at += p.length
        assert at == len(ids[doc_id])
    assert set(got.doc_id) == set(ids)
    for _, window in got.groupby("sequence_id"):
        window = window.sort_values("offset")
        assert list(window.offset) == [0, *np.cumsum(window.length)[:-1]]
        total = window.length.sum()
        assert total <= 4096 and total & (total - 1) == 0


def test_language_model_query(spark, documents):
    words = re.compile(r"[^\x20\x09-\x0D]+")
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {r.doc_id: [*words.findall((r.text or "").translate(fold)), None] for r in documents.itertuples()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in tokens}
    counts = collections.Counter(t for d in tokens if not held[d] for t in tokens[d])
    n = sum(counts.values())
    got = QUERIES["op6_lm_scores"](spark, SF).toPandas().set_index("doc_id")
    assert set(got.index) == set(tokens)
    for d, r in got.iterrows():
        known = sum(t in counts for t in tokens[d])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(tokens[d]), known, n)
        base = math.fsum(math.log10((counts[t] + 1) / (n + len(counts) + 1)) for t in tokens[d])
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0
    out = got[got.held_out & (got.n_tokens > 20)]
    # The model is to explain unseen texts better than counts of single words do.
    assert (out.score / out.n_tokens).mean() > (out.base_score / out.n_tokens).mean()


def base_spans(text):
    def luhn(digits):
        return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0

    def card(match):
        digits = re.sub("[^0-9]", "", match)
        return 16 <= len(digits) <= 19 and luhn(digits)

    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", card),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    return {kind: [m.span() for m in re.finditer(p, text) if ok(m.group())] for kind, (p, ok) in kinds.items()}


def test_personal_data_query(spark, documents):
    got = QUERIES["op10_pii"](spark, SF).toPandas().set_index("doc_id")
    assert len(got) == len(documents)
    for doc in documents.itertuples():
        spans, row = base_spans(doc.text or ""), got.loc[doc.doc_id]
        base = [f"{kind}:{a}:{b}" for kind, found in spans.items() for a, b in found]
        assert [row[f"n_{kind}"] for kind in spans] == [len(found) for found in spans.values()]
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(row.spans.split(","))
