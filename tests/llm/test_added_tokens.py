"""Token ids of texts that hold an added token, against the plain library call."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from test_brute_force import _odd_texts
from tokenizers import Tokenizer

from termloom.llm import token_files


def test_added_tokens(spark, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "it<|endoftext|>'s", "a<|endoftext|>  b", "", "none", *_odd_texts(seed=3)]
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert expected[0] == [64, 220, 50256, 275]
    for ids, own in zip(token_files.WordEncoder(path, special=True).encode(texts), expected):
        assert np.frombuffer(ids, "<u4").tolist() == own
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    token_files.write_ids(docs, str(tmp_path / "ids"), path, 2)
    rows = token_files.read_ids(spark, str(tmp_path / "ids")).orderBy("doc_id").collect()
    assert [list(r.ids) for r in rows] == [[*ids, 2] for ids in expected]
    assert [r.start for r in rows] == np.cumsum([0, *(len(ids) + 1 for ids in expected)])[:-1].tolist()
