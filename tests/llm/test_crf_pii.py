"""Personal data: patterns against plain ones, long runs, and held-out lines for the random field."""

import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridclimate.llm import crf_pii as pii

PLAIN_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
PLAIN_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
PLAIN_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PLAIN_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

HELD_OUT = """
kindly phone [phone:(718) 555-0143] before five
you can call [phone:(206) 555-0192] daily
Tel. [phone:0221 555 0178] Köln
ring [phone:0131 496 0789] soon
fax [phone:(040) 555 07 31] here
dial [phone:1-888-555-0129] free
text [phone:(512) 555-0166] today
telephone [phone:02.44.50.11.98] Lyon
mobile [phone:07911 123456] now
number [phone:555.013.9921] please
contact [email:press [at] example.org] today
mail [email:tom.hill(at)example.com] please
write to [email:office [at] example [dot] net] now
an [email:eva(at)example.de] bitte
pay with [card:6011.1111.1111.1117] now
Visa [card:4111/1111/1111/1111] number
card [card:5105.1051.0510.5100] expired
host [ip:fe80::204:61ff:fe9d:f156] replied
from [ip:2001:db8:ffff:1:201:2ff:fe03:405] to
ping [ip:2001:db8::1428:57ab] failed
at 07:45:10 the bell rang
device 00:25:96:12:34:56 was lost
in 1901 1902 1903 they sailed
the years 1848 1871 1918 matter
from 1618 to 1648 and on
pages 10 20 30 and 50
build 20210504123456 failed
price 12,500.00 for 3 items
section 7.3.2 of part 4
key 9f8e7d6c5b4a39281706f5e4 rotated
on 2011-09-12 and 2012-10-13
chapter 3, verse 16 only
"""


@pytest.fixture(scope="module")
def crf():
    return pii.train_crf()


def plain_base(text):
    out = [(m.start(), m.end(), "email") for m in PLAIN_EMAIL.finditer(text)]
    out += [(m.start(), m.end(), "ip") for m in PLAIN_IP.finditer(text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in PLAIN_CARD.finditer(text):
        digits = re.sub(r"[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((m.start(), m.end(), "card"))
    out += [(m.start(), m.end(), "phone") for m in PLAIN_PHONE.finditer(text)
            if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15]
    return pii.listed(out)


@settings(max_examples=1500, deadline=None)
@given(st.text(st.sampled_from("a1@.._-% +0255(\n"), max_size=60))
def test_base_equals_plain_patterns(text):
    assert pii.listed(pii.base_spans(text, pii.words_with_signals(text))) == plain_base(text)


def test_a_match_may_begin_within_a_run():
    assert [m.group() for m in pii.email_matches("a@b.c_d@e.f%g@h")] == ["a@b.c", "_d@e.f"]


def test_long_runs_of_zeros(crf):
    text = "x " + "0" * 5000 + ".1.1.1 y"
    (base, _), = pii.find_all([text], crf)
    assert base == [(2, len(text) - 2, "ip")]


@pytest.mark.parametrize("text", [
    "a" * 10**6 + "@", "1" * 10**6 + ".", "a@" * 500_000, "1." * 500_000 + "x", "+1" + "(" * 10**6,
    "+" * 10**6 + "1", "a(at)" * 200_000, "1-" * 500_000, "1:" * 500_000, "é" * 10**6 + "1", "@a." * 300_000,
])
def test_long_words_take_linear_time(crf, text):
    begun = time.time()
    pii.find_all([text, f"{text} {text}"], crf)
    assert time.time() - begun < 20


def test_addresses_with_colons():
    good = ["2001:db8::1", "::1", "1::", "1:2:3:4:5:6:7:8", "fe80::1ff:fe23:4567:890a"]
    bad = ["12:30:45", "00:1A:2B:3C:4D:5E", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "12345::1", "::", "a::b::1", ":1::2",
           "1:::2", "face::bad", "std::x1"]
    assert all(map(pii.colon_address, good)) and not any(map(pii.colon_address, bad))


def test_clock_hardware_and_years_are_not_found(crf):
    texts = ["at 12:30:45 we left", "device 00:1A:2B:3C:4D:5E answered", "in 1998 2004 2005 it rained"]
    assert all(spans == [] for _, spans in pii.find_all(texts, crf))


def test_field_on_held_out_lines(crf):
    """Precision and recall of what the field adds, on lines it wasn't trained on."""
    texts, wanted = [], set()
    for k, line in enumerate(filter(str.strip, HELD_OUT.split("\n"))):
        text, at = "", 0
        for m in pii.MARKED.finditer(line):
            text += line[at : m.start()]
            wanted.add((k, len(text), len(text) + len(m[2]), m[1]))
            text, at = text + m[2], m.end()
        texts.append(text + line[at:])
    found = set()
    for k, (base, spans) in enumerate(pii.find_all(texts, crf)):
        found |= {(k, *span) for span in set(spans) - set(base)}
    hits = len(found & wanted)
    print(f"precision {hits}/{len(found)}, recall {hits}/{len(wanted)}", sorted(found ^ wanted))
    assert hits >= 0.9 * len(found) and hits >= 0.8 * len(wanted)
