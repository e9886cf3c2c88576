from __future__ import annotations

import re
from collections import Counter

from tests.llm.conftest import WORD

from riskweave.llm import quality


def brute(text, limits=quality.Limits()):
    text = text or ""
    words = re.findall(WORD, text)

    def marked(n, first=False):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        seen, before = Counter(grams), set()
        later = [g in before or before.add(g) for g in grams]
        return {i + k for i, g in enumerate(grams) if (seen[g] > 1 if first else later[i]) for k in range(n)}

    seen, dup, dup_chars = set(), 0, 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            if line in seen:
                dup += 1
                dup_chars += sum(map(len, re.findall(WORD, line)))
            seen.add(line)
    chars = sum(map(len, words))
    grams = {n: sum(len(words[i]) for i in marked(n)) for n in limits.gram_chars}
    failed = len(words) < limits.min_words or 100 * len(marked(3, True)) > limits.repeat_words * len(words)
    rejected = 100 * dup_chars > limits.line_chars * chars or any(100 * grams[n] > most * chars for n, most in limits.gram_chars.items())
    return (len(words), chars, len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked(3, True)), dup_chars, *grams.values(), failed, not (failed or rejected))


TEXTS = [
    None, "", " \n\t ", "one", "a b c a b c", "x " * 100, "line one here\n" * 20, "\n\n same\n same\nsame\r\nsame\n", "é日 #*$ é日 |<> é日", "a\x0bb\x0cc\x85d e",
    " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i % 55}" for i in range(70)), " ".join(f"w{i}" for i in range(20000)) + " tail " * 50,
]


def test_equals_brute_force(documents_of, sample):
    docs = documents_of(TEXTS)
    got = {r.doc_id: tuple(r)[1:] for r in quality.judge(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}
    rows = {r.doc_id: r.text for r in sample.collect()}
    assert {r.doc_id: tuple(r)[1:] for r in quality.judge(sample).collect()} == {i: brute(t) for i, t in rows.items()}


def test_documents_don_t_mix_within_a_block(documents_of):
    text = " ".join(f"w{i}" for i in range(60))
    got = quality.judge(documents_of([text] * 5, 1)).collect()
    assert all(r.kept and r.n_repeat_words == 0 and r.n_dup_lines == 0 for r in got)


def test_repetition_is_rejected_and_clean_text_kept(documents_of):
    clean = " ".join(f"word{i}" for i in range(200))
    passage = " ".join(f"p{i}" for i in range(30))
    lines = "\n".join(f"l{i} some other words" for i in range(40))
    got = {r.doc_id: r for r in quality.judge(documents_of([clean, f"{clean} {passage} {passage} {passage}", f"{lines}\n{lines}"])).collect()}
    assert got[0].kept and not got[1].kept and not got[1].base_failed and not got[2].kept


def test_good_documents_that_say_a_sentence_twice_are_kept(spark, documents_of):
    words = [f"w{i}" for i in range(70)]
    twice = " ".join([*words[:9], *words, *words[:9]])  # header, body that begins with it, footer: 18 of 88 words are later occurrences
    once_more = " ".join([*words, *words[:6]])
    got = {r.doc_id: r for r in quality.judge(documents_of([once_more, twice])).collect()}
    assert got[0].kept and got[0].dup_chars_5 == sum(map(len, words[:6])) and not got[1].kept
    sf = "/root/testdata/sf0.1"
    judged = quality.judge(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("quality = 1 AND NOT base_failed")
    kept = judged.groupBy("kept").count().collect()
    counts = {r["kept"]: r["count"] for r in kept}
    assert counts.get(False, 0) <= 0.003 * counts[True]


def test_edges(documents_of, clashing):
    assert quality.judge(documents_of([])).count() == 0
    assert [r.doc_id for r in quality.judge(documents_of([(None, "a"), (None, "a")])).collect()] == [None, None]
    assert quality.judge(clashing(["a"])).columns[0] == "doc_id" and quality.judge(clashing(["a"])).count() == 1
