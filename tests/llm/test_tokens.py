import random
import tracemalloc

import pyarrow as pa
from public_tokenizers import path

from lakeretrieve.llm import tokens


def test_blocks_of_texts_need_little_memory():
    deal = random.Random(3)
    words = ["".join(deal.choices("abcdefghij", k=5)) for _ in range(1000)]
    texts = [" ".join(deal.choices(words, k=1000)) for _ in range(100)]
    encoder = tokens.Encoder(path("word_bpe_49k.json"))
    once = [encoder.encode(text) for text in texts]
    tracemalloc.start()
    sizes = [len(ids) for ids in encoder.encode_all(text for _ in range(8) for text in texts)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sizes == [len(ids) for ids in once] * 8
    assert peak < 20 << 20


def test_few_rows_at_once_are_all_rows():
    rows = pa.array([str(i) for i in range(1000)]).slice(3)
    assert list(tokens.few_at_once(rows, 7)) == [str(i) for i in range(3, 1000)]
    assert list(tokens.few_at_once(rows.slice(0, 0))) == []
