"""Words of sliced Arrow arrays."""

import re

import pyarrow as pa

from storelens.llm import ppm, words


def test_slices_give_their_own_words():
    texts = ["Ab\x0bcd  É", None, "", " x\n", "ünï 漢字 ÜBER", "\t"] * 50
    array = pa.array(texts)
    for a, n in ((0, 300), (7, 20), (299, 1), (5, 0)):
        found = words.Words(array.slice(a, n))
        rows = [[found.vocabulary[c] for c in found.codes[i:j]] for i, j in zip(found.starts[:-1], found.starts[1:])]
        lower = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in texts[a:a + n]]
        assert rows == [[w for w in re.split(r"[\x20\x09-\x0D]+", t) if w] for t in lower]
        data, owner, coded = ppm.symbols(array.slice(a, n), 3)
        assert bytes(data[coded & (data != ppm.END)]) == "".join(lower).encode() and int((data == ppm.END).sum()) == n
        batch = pa.record_batch([array.slice(a, n)], ["t"])
        assert [x for p in words.chunks(batch, "t", 40) for x in p.column(0).to_pylist()] == texts[a:a + n]
