"""Secrets in encoded layers that span lines or are not clean text."""

from __future__ import annotations

import base64
import bz2
import gzip
import lzma
import random

import pytest

from quarrystone.llm import secrets


def inside(text, block):
    return [f for f in secrets.findings(text) if f[0] == "assign" and text.index(block) <= f[1] < f[2] <= text.index(block) + len(block)]


@pytest.mark.parametrize("end", ["\n", "\r\n", "\n    "])
@pytest.mark.parametrize("width", [64, 76])
@pytest.mark.parametrize("pack", [gzip.compress, bytes])
def test_wrapped_base64_is_one_token(width, pack, end):
    rng = random.Random(1)
    plain = " ".join(str(rng.random()) for _ in range(20)) + " password=hunter2hunter2hunter2hunter2 " + " ".join(str(rng.random()) for _ in range(20))
    code = base64.b64encode(pack(plain.encode())).decode()
    block = end.join(code[i : i + width] for i in range(0, len(code), width))
    for after in ("end of it", "word", "longerwordsfollow"):
        found = inside(f"before it{end}{block}{end}{after}", block)
        assert found
        if pack is bytes:
            text = f"before it{end}{block}{end}{after}"
            at = code[: (plain.index("password") * 4) // 3]
            assert max(f[2] - f[1] for f in found) >= 48 and min(f[1] for f in found) >= text.index(block) + len(at)


@pytest.mark.parametrize("odd", ["\u00a0", "\u3000", "\u00ad", "\u200b", "\ufeff", "\u2028", "\x00", b"\xff", b"\xe9"])
@pytest.mark.parametrize("pack", [gzip.compress, bytes])
def test_an_odd_character_does_not_hide_a_layer(odd, pack):
    odd = odd if isinstance(odd, bytes) else odd.encode()
    block = base64.b64encode(pack(b"some text before " + odd + b" password=hunter2hunter2 and after")).decode()
    assert inside(f"see {block} end", block)


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, lzma.compress])
def test_all_members_of_a_stream_are_read(pack):
    block = base64.b64encode(pack(b"nothing in the first member\n") + pack(b"password=hunter2hunter2 in the second")).decode()
    assert inside(f"see {block} end", block)


def test_words_are_not_taken_for_layers():
    assert secrets._base64(secrets.BASE64.search("internationalisation")) is None
    assert secrets._base64(secrets.BASE64.search("0123456789abcdef0123456789abcdef")) is None
