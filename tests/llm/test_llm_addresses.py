"""Addresses at the border of what the tagger reads, and spelled ones."""

import pytest

from spendwatch.llm import personal


@pytest.fixture(scope="module")
def tagger():
    return personal.trained()


def found(tagger, text):
    return [text[a:b] for kind, a, b in personal.all_spans(tagger, [text])[0][1] if kind == 0]


def test_no_address_crosses_a_border():
    for address in ("a" * 40 + " @ " + "b" * 40 + ".org", "a" * 30 + " at " + "b" * 22 + " dot org", "name [at] " + "b" * 60 + " [dot] " + "c" * 60 + " [dot] com"):
        text = "plain words before it " * 4 + address + " plain words after it" * 4
        at = text.index(address)
        assert any(a <= at and at + len(address) <= b for a, b in personal.stretches(text))
    assert personal.stretches("only plain words " * 20) == [] == personal.stretches("")


def test_what_is_a_plausible_address():
    assert all(personal.plausible(0, t) for t in ("name at host dot org", "name [at] mail [dot] host [dot] org", "name(at)host.org", "name @ host.org"))
    assert not any(personal.plausible(0, t) for t in ("name at host.org", "name at host", "host dot org", "(at) host dot org"))


def test_spelled_addresses_are_tagged(tagger):
    texts = {form.format(n, h): form for form in ("{} at {} dot org", "{} [at] {} [dot] com", "{}(at){}.de") for n, h in (("marie", "inbox"), ("tom", "sample"), ("karin", "firma"), ("lebrun", "poste"))}
    hits = sum(found(tagger, f"please write to us, {a}, as soon as possible") == [a] for a in texts)
    assert hits >= 9, hits
