"""Surrogates: detection, form, distinctness, and the same surrogate for the same entity."""

import re

import pytest
from pyspark.sql import functions as F

from tests.llm.test_contracts import awkward, rows_of, source
from trendloom.llm import surrogates as S
from trendloom.llm.queries import KEY, QUERIES

CASES = {
    "mail Jo.Doe+x@Mail6.example.com.": ("email", "jo.doe+x@mail6.example.com"),
    "at 239.98.141.179 now": ("ip", "239.98.141.179"),
    "+1 (487) 555-7209": ("phone", "14875557209"),
    "pay 4111 1111 1111 1111 now": ("card", "4111111111111111"),
    "pay 4635346203346400!!": ("card", "4635346203346400"),
    'token = "1a6c4f7bcf8c070fc75a8f6f8ed4b9a36b13d44c"': ("secret", "1a6c4f7bcf8c070fc75a8f6f8ed4b9a36b13d44c"),
    "no 078-05-1120.": ("ssn", "078051120"),
    "to DE89 3704 0044 0532 0130 00 today": ("iban", "DE89370400440532013000"),
    "Mrs. Anna Keller said": ("person", "f|Anna Keller"),
    "господин Иван Петров": ("person", "m|Иван Петров"),
}


@pytest.mark.parametrize("text", CASES)
def test_found_and_replaced_in_form(text):
    (start, end, kind, value), = S.entities(text)
    assert (kind, value) == CASES[text]
    new = S.surrogate(b"k", kind, value)
    assert new == S.surrogate(b"k", kind, value) and new != S.surrogate(b"other", kind, value)
    out = text[:start] + S.in_form(kind, text[start:end], new) + text[end:]
    assert value not in out and len(S.entities(out)) == 1 and S.entities(out)[0][2:] == (kind, new)
    if kind in ("phone", "card", "ssn"):
        assert re.sub(r"\d", "9", out) == re.sub(r"\d", "9", text)


LONG = "Ab1" * 133 + "z"
JWT = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9P"
WHOLE = {
    f"token: {LONG} end": ("secret", LONG),
    f"token: {JWT}. Then": ("secret", JWT),
    'password="abcdefghijkl!größer" x': ("secret", "abcdefghijkl!größer"),
    "token: johndoesurname@mail.com": ("email", "johndoesurname@mail.com"),
    "Mrs Dvořáková said": ("person", "f|Dvořáková"),
    "Mrs Dvor\u030ca\u0301kova\u0301 said": ("person", "f|Dvořáková"),
    "Mr McDonald went": ("person", "m|McDonald"),
    "Mr Łukasz Nowak, they": ("person", "m|Łukasz Nowak"),
    "Mrs Ana O’Neill’s house": ("person", "f|Ana O’Neill"),
    "Mr Juan Carlos García Márquez Díaz is": ("person", "m|Juan Carlos García Márquez Díaz"),
    "Mr J.R. Tolkien F. KENNEDY was": ("person", "m|J.R. Tolkien F. KENNEDY"),
    "господин Їжаков сказав": ("person", "m|Їжаков"),
}


@pytest.mark.parametrize("text", WHOLE)
def test_entities_are_taken_whole(text):
    (start, end, kind, value), = S.entities(text)
    assert (kind, value) == WHOLE[text]
    new = S.surrogate(b"k", kind, value)
    out = text[:start] + S.in_form(kind, text[start:end], new) + text[end:]
    assert S.entities(out) == [(start, start + len(out) - len(text) + end - start, kind, new)]
    assert not set(re.findall(r"\w{4,}", text[start:end])) & set(re.findall(r"\w{4,}", out)) - {"mail"}


def test_names_and_secrets_that_begin_alike_stay_apart():
    assert [x[3] for x in S.entities(f"token: {LONG}a token: {LONG}b")] == [LONG + "a", LONG + "b"]
    assert [x[3] for x in S.entities("Mr Smith Mrs Jones")] == ["m|Smith", "f|Jones"]


def test_card_keeps_its_check_digit():
    def valid(c):
        return S._check_digit(c[:-1]) == c[-1]

    assert valid("4111111111111111") and valid(S.surrogate(b"k", "card", "4111111111111111"))
    assert not valid("4111111111111112") and not valid(S.surrogate(b"k", "card", "4111111111111112"))


def test_plain_text_has_no_entities():
    for text in ("", "Chapter 12, verse 3.4 of 2024-05-06", "a@b", "v1.2.3", "the token of thanks", "1,234,567"):
        assert S.entities(text) == []


def test_distinct_even_where_room_is_small(spark):
    """All two-digit... forms: as many entities as there are forms of that length, so collisions are certain."""
    found = spark.createDataFrame([("phone", f"{i:03d}") for i in range(400)], "kind string, value string")
    made = rows_of(S.surrogates_of(found, b"k"))
    assert len(made) == 400 and len({n for _, _, n in made}) == 400
    assert not {n for _, _, n in made} & {f"{i:03d}" for i in range(400)}


def test_query(spark, sf_dir):
    got = {r[0]: r[1:] for r in rows_of(QUERIES["op9_surrogates"](spark, sf_dir))}
    docs = source(spark, sf_dir).select("doc_id", "text").collect()
    mapping = {}
    assert len(got) == len(docs)
    for d in docs:
        text, n = got[d.doc_id]
        spans = S.entities(d.text or "")
        assert n == len(spans) and (n or text == d.text)
        for _, _, kind, value in spans:
            if kind in ("email", "secret"):
                assert value not in text.lower()
        new = S.entities(text or "")
        for (_, _, kind, value), (_, _, kind2, value2) in zip(spans, new, strict=True):
            assert kind == kind2 and mapping.setdefault((kind, value), value2) == value2
    assert len(set(mapping.values())) == len(mapping) and KEY


def test_hint_passes_every_text_with_an_entity(spark):
    """Numbers in other digits, keys in other cases, titles of other scripts: what Spark lets by has no entity."""
    texts = [*CASES, *WHOLE, "PAS\u017fWORD=abcdefghijklm", "api-\u212aey: abcdefghijklm", "\u212aey", "г-жа Ольга", "no number", ""]
    for zero in ("\u0660", "\u0966", "\uff10", "\U0001d7ce", "\U00011f50", "\U0001e4f0"):
        digits = "".join(chr(ord(zero) + i) for i in range(10))
        texts += [t.translate(str.maketrans("0123456789", digits)) for t in ("no 078-05-1120.", "+1 (487) 555-7209", "pay 4111 1111 1111 1111 now")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    hinted = {r.doc_id for r in docs.where(F.col("text").rlike(S.HINT)).collect()}
    assert all(S.entities(t) == [] for i, t in enumerate(texts) if i not in hinted) and len(hinted) == len(texts) - 2
    got = {r.row.doc_id: (r.n_entities, r.new_text) for r in S.pseudonymised(docs, b"k").collect()}
    assert all(got[i][0] == len(S.entities(t)) and (got[i][0] == 0) == (got[i][1] == t) for i, t in enumerate(texts))


def test_awkward(spark):
    out = S.without_personal_data(awkward(spark), b"k")
    assert out.columns == awkward(spark).columns
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[1].text is None and rows[2].text == "" and rows[6].text.startswith("word word")
    mails = re.findall(r"\S+@[\w.]+\w", rows[14].text)
    assert mails[0] == mails[1].lower() != "a.b@example.com"
    assert S.without_personal_data(awkward(spark, []), b"k").count() == 0
    with pytest.raises(ValueError):
        S.pseudonymised(awkward(spark), b"")


def test_names_agree_part_by_part(spark):
    """Who shares a part of a name shares its surrogate; different names stay different, in gender and script."""
    names = ["m|John Smith", "m|Smith", "f|Smith", "m|John Jones", "m|J. Smith", "m|K. Smith", "f|Ольга Петрова", "m|Петров", "f|Μαρία Παππά", "m|Γιώργος Παππάς"]
    names += [f"m|{a}{b} {c}{d}" for a in ("Ja", "Ke", "Lo", "Mi", "Nu", "Pa") for b in ("ck", "nn", "ris", "tt") for c in ("Bro", "Cla", "Dun") for d in ("wn", "rk", "can")]
    found = spark.createDataFrame([("person", n) for n in names], "kind string, value string")
    new = {v: n for _, v, n in rows_of(S.coreferent(found, b"k"))}
    assert set(new) == set(names) and len(set(new.values())) == len(names) and not set(new.values()) & set(names)
    assert new["m|John Smith"].split()[-1] == new["m|Smith"][2:] == new["f|Smith"][2:] == new["m|K. Smith"].split()[-1]
    assert new["m|John Smith"].split()[0] == new["m|John Jones"].split()[0]
    assert re.fullmatch("m.[A-Z][.] [A-Z][a-z]+", new["m|J. Smith"])
    for name in names:
        assert S._script(name[2:]) == S._script(new[name][2:]) and new[name][:2] == name[:2]
    assert new["f|Ольга Петрова"].endswith("а") and S.entities("Mr " + new["m|John Smith"][2:])[0][3] == new["m|John Smith"]
    assert rows_of(S.coreferent(found.limit(0), b"k")) == []


def test_numbers_keep_their_checks_and_addresses_their_class():
    def valid(iban):
        return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1

    good, bad = "DE89370400440532013000", "DE88370400440532013000"
    assert valid(good) and not valid(bad)
    for counter in range(20):
        assert valid(S.surrogate(b"k", "iban", good, counter)) and not valid(S.surrogate(b"k", "iban", bad, counter))
        assert S.surrogate(b"k", "ip", "10.1.2.3", counter).startswith("10.")
        assert S.surrogate(b"k", "ip", "192.168.1.1", counter).startswith("192.168.")
        assert S.surrogate(b"k", "ip", "172.31.0.9", counter).startswith("172.31.")
