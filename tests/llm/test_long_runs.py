"""Long runs without a blank, of characters that stand next to each other in no piece."""

import public_tokenizers
import pytest
import sentencepiece

from veristrata.llm import wfst


@pytest.mark.parametrize("run", ["7", "0123456789", "你好世界", "😀", "ひらがな", "ไทย", "한국어"])
def test_long_runs(run):
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    text = (run * 5000)[:5000]
    m = wfst.load()
    for t in (text, f"a {text} b", f"abc{text}def{text}"):
        assert m.encode(t) == lib.encode(t)
        assert m.decode(m.encode(t)) == t
