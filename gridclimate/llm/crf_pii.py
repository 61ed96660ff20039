"""Personal data by fixed patterns and a linear-chain conditional random field.

The patterns find e-mail and network addresses, card numbers and phone numbers in their usual
forms. The random field reads the shapes of words and their neighbours and finds other forms, such
as phone numbers without a country code, cards with dots, or addresses that spell out the sign. It
is trained by maximum likelihood from the small labelled table below, and decoded by Viterbi for
many word sequences at a time.

The field only looks around words with a digit, an at sign or a spelt-out one: all other words are
outside by definition, so a text is cut into short sequences of such words with two words on
either side. What it finds must also have the number of digits of its kind, and doesn't replace
what a pattern has found.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import row_of, slices

KINDS = ("email", "ip", "card", "phone")
# The patterns of the four kinds. The first two only look at the beginnings of runs
# of their characters, and don't give any of a run back: no other place of a run matches unless its
# beginning does, so a long run is read once.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
EMAIL_RUN = re.compile(r"(?<![A-Za-z0-9._%+-])" + EMAIL.pattern)
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SIGNAL = re.compile(r"[0-9@]+|[\[({]\s?at\s?[\])}]")
WORD = re.compile(r"\S+")
TO_BLANK = re.compile(r"\S*")
AROUND = 2  # words on either side
REACH = 64  # characters in which they are looked for
LONGEST = 320  # characters of what the field may find; no address is longer

# The labelled table: what is in brackets is personal data of the kind before the colon.
LABELLED = """
call me at [phone:(017) 555-0134] after six
our office [phone:(212) 555-0199] is open daily
phone [phone:555-867-5309] for details
tel. [phone:020 7946 0958] or write
Tel: [phone:0171 555 0123] Berlin
reach her on [phone:555-0142-778] today
mobile [phone:07700 900123] any time
fax [phone:(030) 555 01 23] office
dial [phone:1-800-555-0175] now
telephone [phone:01.55.50.01.99] Paris
número [phone:91 555 01 24] gracias
the number is [phone:555.014.7788] she said
text [phone:(555) 010-2233] please
ring [phone:0161 496 0345] before noon
call [phone:(415) 555-0187] or [phone:(415) 555-0188] soon
Telefon [phone:089 5550 1177] bitte
and [phone:(646) 555-0111] the
of [phone:(303) 555-0155] that
write to [email:jane.doe [at] example.com] today
mail [email:info(at)example.org] for more
contact [email:sales [at] example [dot] net] please
an [email:max.muster(at)example.de] senden
escriba a [email:ana[at]example.es] pronto
e-mail [email:bob {at} example.com] thanks
the [email:kim_lee [at] example.com] and
pay with [card:4111.1111.1111.1111] please
card [card:5500.0000.0000.0004] expired
Visa [card:4012/8888/8888/1881] number
charged to [card:3782_822463_10005] yesterday
Karte [card:6011.0009.9013.9424] gilt
server [ip:2001:db8:85a3::8a2e:370:7334] is down
host [ip:fe80::1ff:fe23:4567:890a] replied
ping [ip:2001:db8::ff00:42:8329] failed
from [ip:2001:0db8:0000:0000:0000:ff00:0042:8329] to
address [ip:192-0-2-44] in the log
released under version 2.0 of the licence
Version 3 or any later version.
Licensed under the Apache License, Version 2.0.
in 1998 and 2004 we went
on 12/05/2019 at 10:30 sharp
the price is 1,299.00 euros
chapter 12, pages 33-47 only
token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" here
key a3f5c9d1e7b24680 was revoked
password = "hunter22" and more
id 123456789 in the table
order 4500123987 shipped
about 1500 people in 3 towns
from 2001-04-17 until 2003-11-30
room 101 on floor 4
ISBN 978-3-16-148410-0 in print
a 16:9 screen of 1920x1080 pixels
section 4.2.1 says so
items 1) 2) 3) follow
the 2nd and 3rd of 5
x1 = 17.25; y2 = 3e10
sku AB-1234-99 sold
add 250 g of flour and 2 eggs
v1.4.7-beta2 is out
sha 9f86d081884c7d659a2feaa0c55ad015 matches
score 3-2 after 90 minutes
@home and @work are handles
meet at noon on day 5
und 24 Uhr am 3. Mai
el 5 de mayo de 1862
le 14 juillet 1789
population 8,336,817 in 2020
http://example.com/a/12345 opened
file_2021_03_04.txt was read
commit 5d41402abc4b2a76b9719d911017c592 fixed
the (at) sign is a sign
in 1998 2004 2005 it rained
the years 1931 1932 1933 were dry
from 1914 to 1918 and 1939 to 1945
between 1950 2000 2010 and now
at 12:30:45 we left
the race took 02:14:09 in all
logged 23:59:59 and 00:00:01 too
device 00:1A:2B:3C:4D:5E answered
mac 08:00:27:9f:3e:11 was seen
scores of 10 20 30 and 40
lines 100 200 300 400 of it
rows 1024 2048 4096 8192 fit
a sum of 12 000 000 euros
mobile [phone:0151 2345 6789] geht
call [phone:0207 946 0123] or [phone:0207 946 0124] now
ring [phone:555 0100 2244] later
host [ip:2001:db8:1:2:3:4:5:6] is up
route [ip:2a00:1450:4001:81b::200e] works
"""
MARKED = re.compile(r"\[(email|ip|card|phone):((?:[^\[\]]|\[[^\[\]]*\])*)\]")
LABELS = ["O", *(f"{b}-{k}" for k in KINDS for b in "BI")]


def shape(word: str) -> str:
    """Runs of digits by length, letters as one sign each run, hexadecimal mixtures as one."""
    if re.fullmatch(r"[\"'=(]*[0-9a-fA-F]{16,}[\"').,;]*", word) and not word.isdigit():
        return "hex"
    word = re.sub(r"[^\W\d_]+", "a", word)
    return re.sub(r"[0-9]+", lambda m: f"d{min(len(m.group()), 20)}", word)[:40]


def word_features(word: str) -> list[str]:
    """What describes a word by itself."""
    digits = sum(c.isdigit() for c in word)
    plain = word.strip(".,;:!?()[]{}\"'").lower()
    signs = "".join(sorted(set(re.sub(r"[\w\s]", "", word))))[:8]
    features = [
        f"shape {shape(word)}",
        f"signs {signs}",
        f"digits {min(digits, 20)}",
        f"only {plain.isdigit()} {any(c.isalpha() for c in plain)}",
        f"colons {word.count(':') > 1}",
    ]
    return features + [f"word {plain}"] * plain.isalpha()


def sequence_features(words: list[str]) -> list[list[str]]:
    """Features of each word: its own, and those of the words on either side."""
    own = [word_features(w) for w in words]
    none = ["edge"]
    return [
        [
            "bias",
            *own[k],
            *(f"before {f}" for f in (own[k - 1] if k else none)),
            *(f"after {f}" for f in (own[k + 1] if k + 1 < len(words) else none)),
        ]
        for k in range(len(words))
    ]


def labelled_sequences(table: str = LABELLED) -> list[tuple[list[str], list[int]]]:
    """Words and labels of each line of a labelled table."""
    out = []
    for line in filter(str.strip, table.split("\n")):
        text, spans, at = "", [], 0
        for found in MARKED.finditer(line):
            text += line[at : found.start()]
            spans.append((len(text), len(text) + len(found[2]), found[1]))
            text += found[2]
            at = found.end()
        text += line[at:]
        words, labels = [], []
        for word in WORD.finditer(text):
            label = "O"
            for begin, end, kind in spans:
                if begin < word.end() and word.start() < end:
                    label = f"{'B' if word.start() <= begin else 'I'}-{kind}"
            words.append(word.group())
            labels.append(LABELS.index(label))
        out.append((words, labels))
    return out


@dataclass
class Crf:
    """Weights of features (by name, per label) and of label transitions."""

    features: dict[str, int]
    weights: np.ndarray
    transitions: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(LABELS)))
        for k, features in enumerate(sequence_features(words)):
            known = [self.features[f] for f in features if f in self.features]
            out[k] = self.weights[known].sum(0)
        return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis, keepdims=True)
    return (most + np.log(np.exp(x - most).sum(axis, keepdims=True))).squeeze(axis)


def train_crf(table: str = LABELLED, penalty: float = 0.02, steps: int = 150) -> Crf:
    """Maximum likelihood with a penalty on squares, by full-batch Adam; always the same result."""
    sequences = labelled_sequences(table)
    features: dict[str, int] = {}
    rows = [
        [[features.setdefault(f, len(features)) for f in fs] for fs in sequence_features(words)]
        for words, _ in sequences
    ]
    n = len(LABELS)
    values = np.zeros((len(features) + n, n))
    mean, square = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, steps + 1):
        gradient = -penalty * values
        weights, moves = values[:-n], values[-n:]
        for places, (_, labels) in zip(rows, sequences):
            score = np.array([weights[p].sum(0) for p in places])
            ahead, back = [score[0]], [np.zeros(n)]
            for k in range(1, len(score)):
                ahead.append(score[k] + _logsum(ahead[-1][:, None] + moves, 0))
            for k in range(len(score) - 1, 0, -1):
                back.append(_logsum(moves + (score[k] + back[-1])[None, :], 1))
            back.reverse()
            whole = _logsum(ahead[-1], 0)
            for k, p in enumerate(places):
                share = np.exp(ahead[k] + back[k] - whole)
                share[labels[k]] -= 1
                gradient[p] -= share
                if k:
                    joint = ahead[k - 1][:, None] + moves + (score[k] + back[k])[None, :] - whole
                    gradient[-n:] -= np.exp(joint)
                    gradient[len(features) + labels[k - 1], labels[k]] += 1
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        values += 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    return Crf(features, values[:-n], values[-n:])


def viterbi(emissions: list[np.ndarray], transitions: np.ndarray) -> list[np.ndarray]:
    """The likeliest labels of many sequences, all moved on together; the first label on ties."""
    if not emissions:
        return []
    lengths = np.array([len(e) for e in emissions])
    n = transitions.shape[0]
    padded = np.zeros((len(emissions), lengths.max(), n))
    for k, e in enumerate(emissions):
        padded[k, : len(e)] = e
    best, back = padded[:, 0], np.zeros(padded.shape, np.int16)
    finals = np.where((lengths == 1)[:, None], best, 0)
    for step in range(1, lengths.max()):
        options = best[:, :, None] + transitions[None]
        back[:, step] = options.argmax(1)
        best = options.max(1) + padded[:, step]
        finals = np.where((lengths == step + 1)[:, None], best, finals)
    label, out = finals.argmax(1), np.zeros(padded.shape[:2], np.int16)
    rows = np.arange(len(emissions))
    for step in range(lengths.max() - 1, -1, -1):
        here = step < lengths
        out[here, step] = label[here]
        label = np.where(here & (step > 0), back[rows, step, label], label)
    return [out[k, :m] for k, m in enumerate(lengths)]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def words_with_signals(text: str) -> list[tuple[int, int]]:
    """Spans of the words with a digit, an at sign or a spelt-out one."""
    spans, upto = [], 0
    for found in SIGNAL.finditer(text):
        if found.start() < upto:
            continue
        begin = found.start()
        while begin > upto and not text[begin - 1].isspace():
            begin -= 1
        upto = TO_BLANK.match(text, found.end()).end()
        spans.append((begin, upto))
    return spans


def email_matches(word: str) -> Iterator[re.Match]:
    """Leftmost matches; only the end of one can lie within a run in which the next one begins."""
    upto = 0
    while found := upto and EMAIL.match(word, upto) or EMAIL_RUN.search(word, upto):
        yield found
        upto = found.end()


def in_a_byte(digits: str) -> bool:
    """Whether a number is at most 255."""
    digits = digits.lstrip("0")
    return len(digits) < 4 and int(digits or "0") <= 255


def base_spans(text: str, words: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """What the patterns find, without what fails its check; addresses lie within words."""
    out = []
    for begin, end in words:
        word = text[begin:end]
        if "@" in word:
            out += [(begin + m.start(), begin + m.end(), "email") for m in email_matches(word)]
        if "." in word:
            out += [
                (begin + m.start(), begin + m.end(), "ip")
                for m in IP.finditer(word)
                if all(map(in_a_byte, m.group().split(".")))
            ]
    if not words:
        return out
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return out


def sequences_of(text: str, words: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Spans of words in sequences: those with signals, what lies between near ones, and around.

    Two words on either side are looked for within 64 characters and are cut there.
    """
    out: list[list[tuple[int, int]]] = []
    for begin, end in words:
        if out and begin - out[-1][-1][1] <= 1 and text[out[-1][-1][1] : begin] == " ":
            out[-1].append((begin, end))
        else:
            out.append([(begin, end)])
    for sequence in out:
        start, stop = sequence[0][0], sequence[-1][1]
        left = max(0, start - REACH)
        before = [(left + m.start(), left + m.end()) for m in WORD.finditer(text[left:start])]
        after = [(stop + m.start(), stop + m.end()) for m in WORD.finditer(text[stop : stop + REACH])]
        sequence[:0] = before[-AROUND:]
        sequence.extend(after[:AROUND])
    return out


def colon_address(found: str) -> bool:
    """Eight groups of one to four hexadecimal digits, or fewer with one gap of two colons."""
    groups = found.split(":")
    if found.count("::") == 1 and ":::" not in found:
        full = [g for g in groups if g]
        edges = groups[0] or found.startswith("::"), groups[-1] or found.endswith("::")
        if not all(edges) or len(full) > 7:
            return False
        groups = full
    elif len(groups) != 8:
        return False
    hexadecimal = all(re.fullmatch(r"[0-9A-Fa-f]{1,4}", g) for g in groups)
    return bool(groups) and hexadecimal and any(c.isdigit() for c in found)


def plausible(kind: str, found: str) -> bool:
    """Whether what the field has found has the make of its kind."""
    if len(found) > LONGEST:
        return False
    digits = sum("0" <= c <= "9" for c in found)
    if kind == "phone":
        return 7 <= digits <= 15 and not re.search(r"[^\W\d]", found)
    if kind == "card":
        return 12 <= digits <= 19 and luhn(re.sub(r"[^0-9]", "", found))
    if kind == "ip":
        dashed = re.fullmatch(r"[0-9]{1,3}(-[0-9]{1,3}){3}", found)
        return colon_address(found) or bool(dashed) and all(map(in_a_byte, found.split("-")))
    return bool(re.search(r"\w\s?[\[({]\s?at\s?[\])}]\s?\w+.*(\.|dot)", found))


def labelled_spans(text: str, sequence, labels) -> list[tuple[int, int, str]]:
    """Spans of the runs of one kind, without signs at their ends, if plausible."""
    out, k = [], 0
    while k < len(labels):
        if not labels[k]:
            k += 1
            continue
        kind, last = (labels[k] - 1) // 2, k
        while last + 1 < len(labels) and labels[last + 1] == 2 * kind + 2:
            last += 1
        begin, end = sequence[k][0], sequence[last][1]
        found = text[begin:end]
        inner = found.rstrip(".,;:!?'\"") if kind != 1 else found.rstrip(".,;!?'\"")
        lead = len(inner) - len(inner.lstrip("'\"=,;"))
        if plausible(KINDS[kind], inner[lead:]):
            out.append((begin + lead, begin + len(inner), KINDS[kind]))
        k = last + 1
    return out


def listed(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def find_all(texts: list[str], crf: Crf) -> list[tuple[list, list]]:
    """For each text the spans of the patterns, and these with those of the random field."""
    bases, sequences, owners = [], [], []
    for k, text in enumerate(texts):
        words = words_with_signals(text)
        bases.append(base_spans(text, words))
        for sequence in sequences_of(text, words):
            sequences.append(sequence)
            owners.append(k)
    added: list[list] = [[] for _ in texts]
    for start in range(0, len(sequences), 512):
        part = sequences[start : start + 512]
        own = owners[start : start + 512]
        emissions = [crf.emissions([texts[k][b:e] for b, e in s]) for k, s in zip(own, part)]
        for k, s, labels in zip(own, part, viterbi(emissions, crf.transitions)):
            if labels.any():
                added[k] += labelled_spans(texts[k], s, labels)
    out = []
    for base, more in zip(bases, added):
        free, upto = [], 0
        for s in sorted(more, key=lambda s: (s[0], -s[1])):
            # Neighbouring sequences may share words, and with them a find.
            if s[0] >= upto and not any(b < s[1] and s[0] < e for b, e, _ in base):
                free.append(s)
                upto = s[1]
        out.append((listed(base), listed(base + free)))
    return out


SPAN = pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64())])


def find_personal_data(
    docs: DataFrame, crf: Crf | None = None, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Every row of ``docs`` as ``row`` (all columns, or those to ``keep``), with ``base`` and ``spans``: lists of kind, begin, end.

    Places are in code points, the end exclusive; lists are in order of begin, then of kind.
    ``base`` has what the patterns find, ``spans`` also what the random field adds. NULL texts
    count as empty and have no spans. Whole texts are read, no other column is.
    """
    crf = crf or train_crf()
    rows = docs.select(
        row_of(docs, keep),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(crf)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = find_all(batch.column(1).to_pylist(), shared.value)
            columns = [
                pa.array(
                    [[{"kind": k, "begin": b, "end": e} for b, e, k in pair[side]] for pair in found],
                    pa.list_(SPAN),
                )
                for side in (0, 1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["row", "base", "spans"])

    spans = "array<struct<kind:string,begin:bigint,end:bigint>>"
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(find, f"row {kind}, base {spans}, spans {spans}")
