from __future__ import annotations

import numpy as np
from tokenizers import Tokenizer

from cardflow.llm import packing


def test_units_go_to_the_tokenizer_in_short_texts():
    """Also where the last of them is not full; the ids are those of the whole text."""
    path = packing.tokenizer_path()
    assert packing.LINES <= 64
    words = [f"unit{i}x{i * i}" for i in range(3 * packing.LINES + 5)]
    text = " ".join(words) + ".\n\n" + ", ".join(words[::-1])
    (parts,) = packing._cache(path).texts([text])
    expected = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(b"".join(parts), dtype="<u4").tolist() == expected
