"""Texts that look like marks of the coder's own, and pages whose tags never close."""
import random
import re
import time

from tokenizers import Tokenizer

from riskspark.llm import bpe, langid
from riskspark.llm.queries import VOCABULARY

#: What :func:`langid.visible` takes out, as one pattern (which needs quadratic time on unclosed tags).
HIDDEN = re.compile(r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<nav\b.*?</nav\s*>|<[^>]*>")


def test_bpe_on_control_characters():
    coder, own, rng = bpe.loaded(VOCABULARY), Tokenizer.from_file(VOCABULARY), random.Random(7)
    pool = [chr(c) for c in range(33)] + ["\n\0added:", "added:", "<|endoftext|>", "<|endoftext", "foo", " ", "\x7f", "\x85", "é"]
    texts = ["x\n\0added:foo", "\n\0added:<|endoftext|>", "<|endoftext|>" * 3]
    texts += ["".join(rng.choices(pool, k=rng.randint(1, 40))) for _ in range(3000)]
    for text, ids in zip(texts, coder.encode_many(texts), strict=True):
        assert ids.tolist() == own.encode(text, add_special_tokens=False).ids, text


def test_visible_text_equals_the_pattern():
    rng = random.Random(8)
    pool = ["<script", "</script>", "</SCRIPT >", "<style>", "</style>", "<!--", "-->", "<nav", "</nav>", "<navy>", "<", ">", "<p>", "a", " ",
            "&amp;", "\n", "<scripty", "\u017f", "cript", "</script", "--", "!"]
    for _ in range(20000):
        page = "".join(rng.choices(pool, k=rng.randint(0, 25)))
        assert langid.visible(page) == langid.entities.unescape(HIDDEN.sub(" ", page)), page


def test_unclosed_tags_take_linear_time():
    began = time.process_time()
    for part in ("<!--", "<script ", "<nav x", "<", "<style></script", "</script   "):
        langid.visible(part * (1_000_000 // len(part)))
    assert time.process_time() - began < 20
