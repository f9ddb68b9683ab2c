"""Registered operators against brute force, on a small table and on odd texts."""

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratacast.llm.chat import chat_digest, escape, format_chats, format_turns, unescape
from stratacast.llm.decontaminate import contamination
from stratacast.llm.licenses import NOTICES, default_templates, license_scan
from stratacast.llm.pii import find_spans, pii, redacted
from stratacast.llm.quality_rules import quality_rules
from stratacast.llm.queries import CONTROL_TEXT, tokenizer_definition
from stratacast.llm.token_files import token_output
from tests.llm import reference


def by_id(df, *cols):
    return {r[0]: tuple(r)[1:] for r in df.select("doc_id", *cols).collect()}


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


@pytest.fixture(params=["small", "odd"])
def corpus(request, small, small_docs, odd_docs, odd_rows):
    return (small["documents"], small_docs) if request.param == "small" else (odd_docs, pairs(odd_rows))


def test_contamination(spark, small, corpus):
    docs, rows = corpus
    items = pairs(small["benchmark"].collect())
    long_text = next(t for _, t in rows if t and len(t.split()) > 200)
    words = long_text.split()
    items += [(900, " ".join(words[20:27])), (901, None), (902, "one"), (903, "!!"), (904, " ".join(words[50:80]).upper())]
    frame = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "0 AS _words")
    cols = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    got = by_id(contamination(docs, frame), *cols)
    assert got == reference.contamination(rows, items)
    assert any(v[4] for v in got.values())


def test_contamination_of_nothing(odd_docs, small):
    none = contamination(odd_docs, small["benchmark"].limit(0))
    assert none.where("n_hit > 0 OR contaminated").count() == 0 and none.count() == odd_docs.count()
    assert contamination(odd_docs.limit(0), small["benchmark"]).count() == 0


def test_repeated_rows_and_null_ids(spark, small):
    text = small["benchmark"].first()["text"]
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (None, None)], "doc_id long, text string")
    got = by_id(contamination(docs, small["benchmark"]), "n_hit", "contaminated")
    assert set(got) == {1, None} and got[1] == got[None] and got[1][1]


def test_token_files(corpus):
    docs, rows = corpus
    definition = tokenizer_definition("word_bpe_49k.json")
    got = by_id(token_output(docs, definition), "start", "n_tokens", "ids_crc32")
    assert got == reference.tokens(rows, Tokenizer.from_str(definition))


def test_token_files_of_nothing(odd_docs):
    assert token_output(odd_docs.limit(0), tokenizer_definition("word_bpe_49k.json")).count() == 0


def test_pii(corpus):
    docs, rows = corpus
    got = by_id(pii(docs), "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    assert got == {doc: reference.base_pii(text) for doc, text in rows if len(text or "") < 30_000} | {
        doc: got[doc] for doc, text in rows if len(text or "") >= 30_000
    }


def test_pii_methods(odd_docs):
    kinds = {s[2] for s in find_spans("IBAN DE89 3704 0044 0532 0130 00, ssn 123-45-6789")}
    assert {"iban", "ssn"} <= kinds
    assert not {s[2] for s in find_spans("DE89 3704 0044 0532 0130 01 and 123-45-6789")} & {"iban", "ssn"}
    clean = redacted(odd_docs)
    assert clean.columns == odd_docs.columns and clean.count() == odd_docs.count()
    assert clean.where("text LIKE '%a.b@c.de%'").count() == 0
    assert clean.where("text IS NULL").count() == 1


def test_quality_rules(corpus):
    docs, rows = corpus
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    result = quality_rules(docs)
    assert by_id(result, *cols) == {doc: reference.rule_counts(text) for doc, text in rows}
    assert result.where("base_failed AND kept").count() == 0


def test_quality_rules_follow_their_group(spark):
    plain, marked = "word " * 3, "word# " * 3
    texts = [("a", f"{plain}{n} " * 9) for n in range(300)] + [("b", f"{marked}{n} " * 9) for n in range(300)]
    texts += [("a", f"{marked}x " * 3 + "y z " * 9)]
    rows = [(n, " ".join(f"{w}{k}" if w == "word" else w for k, w in enumerate(t.split())), "en", s) for n, (s, t) in enumerate(texts)]
    kept = by_id(quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")), "kept")
    assert not kept[600][0]


def _mixed_groups():
    """Two sources: a's texts hold 0 to 4 marks in 40 words, b's 10 to 14; the same 14 marks fail in a alone."""
    rows = []
    for n in range(60):
        for source, least in (("a", 0), ("b", 10)):
            words = [f"w{n}x{k}" for k in range(40)]
            for k in range(least + n % 5):
                words[k] += "#"
            rows.append((len(rows), " ".join(words), "en", source))
    for source in "ab":
        rows.append((len(rows), " ".join(f"odd{k}" + "#" * (k < 14) for k in range(40)), "en", source))
    rows.append((len(rows), " ".join(f"few{k}" + "#" * (k < 14) for k in range(40)), "en", "c"))
    return rows


def test_quality_fences_come_from_the_group(spark):
    docs = spark.createDataFrame(_mixed_groups(), "doc_id long, text string, lang string, source string")
    kept = by_id(quality_rules(docs, min_group=20), "kept")
    assert (kept[120][0], kept[121][0]) == (False, True)
    # A small group is held against its language, whose spread is wide.
    assert kept[122][0] and all(v[0] for k, v in kept.items() if k < 120)
    assert by_id(quality_rules(docs, min_group=20, fence=20.0), "kept")[120][0]


def test_quality_verdicts_against_brute_force(spark):
    rows = _mixed_groups()
    for n in range(200, 260):
        words = [f"v{n}y{k}" + "y" * (n % 7) for k in range(30 + n % 3)]
        text = " ".join(words) + "\nsame\nsame" * (n % 20 == 0) + "\n" + " ".join(words[: 12 * (n % 30 == 1)] * 2)
        rows.append((n, text + "z" * (300 * (n == 259)), ("fr", None)[n % 2], None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = by_id(quality_rules(docs, min_group=20), "base_failed", "kept")
    assert got == reference.rule_verdicts(rows, min_group=20, tail=0.1, fence=3.0)
    assert {v for v in got.values()} >= {(False, True), (False, False)}


def test_empty_tables(odd_docs, small, spark):
    assert quality_rules(odd_docs.limit(0)).count() == 0
    assert pii(odd_docs.limit(0)).count() == 0
    assert license_scan(odd_docs.limit(0), default_templates(spark)).count() == 0
    assert format_chats(small["conversations"].limit(0)).count() == 0


def test_chats(spark, small):
    rows = [tuple(r) for r in small["conversations"].select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT), (-2, 0, None, None), (-2, 0, "assistant", "x")]
    rows += [(-3, None, "a\nb\\n<|im_end|>", "<\\|<|"), (-3, 1, "assistant", ""), (-3, 1, "assistant", "")]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").selectExpr("*", "1 AS turns")
    got = {r[0]: tuple(r)[1:5] for r in chat_digest(format_chats(frame)).collect()}
    assert got == reference.chats([(c, -1 if t is None else t, r, x) for c, t, r, x in rows])


def test_escape_is_reversible():
    for text in ("", "<|", "<\\|", "<\\\\|x<|<|", "|<", "<|im_end|>"):
        assert unescape(escape(text)) == text and "<|" not in escape(text)


def test_rewriting_templates_are_detected():
    turns = [("user", "hi"), ("assistant", "think then say"), ("user", "more"), ("assistant", "done")]

    def keeps_last(given):
        last = len(given) - 1
        return "".join(f"[{r}]{'' if r == 'assistant' and k < last else t}[/]" for k, (r, t) in enumerate(given))

    out = format_turns(turns, keeps_last)
    assert out["rewrites_history"] and not out["turn_spans"]
    assert [out["formatted"][a:b] for a, b in out["loss_spans"]][-1] == "done"
    appended = format_turns(turns, lambda given: "".join(f"[{r}]{t}[/]" for r, t in given))
    assert not appended["rewrites_history"]
    assert [appended["formatted"][a:b] for a, b in appended["loss_spans"]] == ["think then say", "done"]


def test_licenses(spark, corpus):
    docs, rows = corpus
    result = license_scan(docs, default_templates(spark))
    got = by_id(result, "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == {doc: reference.license_places(text) for doc, text in rows}


def test_license_notices(spark, odd_docs):
    labels = by_id(license_scan(odd_docs, default_templates(spark)).where(F.size("spans") > 0), "labels", "score")
    assert labels[91][0] == "gpl" and labels[91][1] > 0.9
    assert labels[84][0] == "apache,gpl,mit"


def _notice_texts():
    """(id, text, labels): whole notices, words put in, left out and replaced, halves, two copies, lone common words."""
    mit, bsd = NOTICES["mit"][0].split(), NOTICES["bsd"][0].split()
    pad = [f"pad{k}" for k in range(300)]
    half = len(mit) // 2
    texts = [
        (pad + mit + pad, "mit"),
        (pad + mit[:half] + pad[:5] + mit[half:] + pad, "mit"),
        (pad + mit[:half] + pad[:25] + mit[half:], "mit"),
        (mit[:20] + mit[26:] + pad, "mit"),
        (mit[:15] + pad[:4] + mit[15:30] + pad[:4] + mit[36:], "mit"),
        ([w if k % 12 else "other" for k, w in enumerate(mit)], "mit"),
        (mit[:half] + pad, ""),
        (mit[:half] + pad + mit[:half], ""),
        (mit + bsd + mit, "bsd,mit"),
        (" ".join(mit[:12]).split() * 40, ""),
        (pad[:40] * 30 + mit[:half] + pad[:7] + mit[half:] + pad[:40] * 30, "mit"),
        (["the", "of", "software", "to", "and"] * 100, ""),
    ]
    return [(k, " ".join(words), labels) for k, (words, labels) in enumerate(texts)]


def test_license_notices_with_insertions_and_deletions(spark):
    rows = _notice_texts()
    frame = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = license_scan(frame, default_templates(spark)).collect()
    assert {r["doc_id"]: r["labels"] for r in got} == {doc: labels for doc, _, labels in rows}
    spans = {r["doc_id"]: [(s["label"], s["start"], s["end"]) for s in r["spans"]] for r in got}
    size = len(reference.ITEM.findall(reference.lower(NOTICES["mit"][0])))
    assert spans[0] == [("mit", 300, 300 + size)] and spans[1] == [("mit", 300, 305 + size)]
    assert [s[0] for s in spans[8]] == ["mit", "bsd", "mit"]
    assert {r["score"] for r in got if r["doc_id"] in (0, 1, 8, 10)} == {1.0}


def test_license_labels_against_brute_force(spark):
    """Every window of three lengths of every template, compared whole: nothing that a scan of all places would find is lost."""
    rows = _notice_texts()
    frame = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = by_id(license_scan(frame, default_templates(spark)), "labels")
    for doc, text, _ in rows:
        assert got[doc][0] == reference.notice_labels(text, NOTICES), doc
