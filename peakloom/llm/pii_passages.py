"""Annotated passages for the personal-data model: three sets of sentences that share no sentence with each other."""

from __future__ import annotations

import random

# Sentences with personal data (in braces what the data is), and sentences whose numbers are none.
# The first set fits the trees, the second calibrates them, the third measures precision and recall.
PERSONAL = (
    (
        "You can reach me on {phone} until noon.",
        "My cell is {phone}, the office one is out of order.",
        "Call {phone} and ask for Maria.",
        "tel {phone}",
        "Her social security number is {ssn}.",
        "SSN: {ssn}",
        "Please transfer the rent to {iban} by Friday.",
        "IBAN {iban}",
        "Write to {mail} for the keys.",
        "contact: {mail}",
        "{mail} works best for the whole team",
        "Send drafts over to {mail} before lunch.",
        "Passport {passport} was issued in Lyon.",
        "Patient number {ssn}, born in 1984.",
        "She lives at {street} with two cats.",
        "Ship it to {street}, second floor.",
        "{phone}",
        "{word} {word} {phone} {word}",
    ),
    (
        "Ring {phone} after six.",
        "mobile: {phone}",
        "Text us at {phone} for a table.",
        "The form wants your social ({ssn}).",
        "tax id {ssn}",
        "Account {iban} belongs to my sister.",
        "bank details: {iban}",
        "Just mail {mail} instead.",
        "or try {mail}, she answers fast",
        "{mail} gets forwarded",
        "passport no. {passport}",
        "He moved to {street} in May.",
        "Our address: {street}.",
        "{word} {phone} {word} {word}",
    ),
    (
        "Phone {phone} to book.",
        "Fax {phone}",
        "You'll find me under {phone}.",
        "social security: {ssn}",
        "Citizen {ssn} appealed.",
        "pay into {iban} please",
        "Our {iban} account was closed.",
        "reach out to {mail} with questions",
        "{mail} is my new one",
        "travel document passport {passport}",
        "Deliver to {street}.",
        "I grew up at {street}, near the river.",
        "{word} {word} {word} {phone}",
    ),
)
OTHER = (
    (
        "Order {digits} has been shipped.",
        "Invoice {digits} of {date} is due.",
        "The total is {money} without tax.",
        "ISBN {isbn}, second edition.",
        "The match ended {scores}.",
        "See pages {range} of the report.",
        "Version {version} fixes it.",
        "Built on {date}, serial {digits}.",
        "The area grew from {range} hectares.",
        "Tracking {code} is on its way.",
        "Coordinates {coords} point to the lake.",
        "They met at noon. Then they left.",
        "She looked at him. Nothing moved.",
        "{word} {digits} {word}",
        "lot {code}",
        "In {range} the war went on.",
        "{word} at {word}. {Word} {word}",
        "The city closed {count} Broad Street shops.",
        "We counted {count} Green Lane trees.",
    ),
    (
        "Ticket {digits} is closed.",
        "ref. {digits}",
        "It cost {money} in all.",
        "isbn {isbn}",
        "a score of {scores} points",
        "from {range} on",
        "release {version} is out",
        "measured on {date} at noon",
        "part {code} is missing",
        "at {coords} we turned back",
        "We sat at home. All was quiet.",
        "{Word} at {word}. {Word} {word} {word}",
        "{word} {word} {digits}",
        "There were {count} Old Street lamps.",
    ),
    (
        "Receipt {digits}, keep it.",
        "case {digits} was dropped",
        "a budget of {money}",
        "The book (ISBN {isbn}) sold well.",
        "they lost {scores} that night",
        "rows {range} are empty",
        "patch {version}",
        "dated {date}",
        "model {code} was recalled",
        "the marker {coords} is wrong",
        "He laughed at it. She didn't.",
        "{word} {word} at {word}. {Word}",
        "{digits} {word} {word}",
        "About {count} New Road signs fell.",
    ),
)
ROADS = ("Street", "Road", "Avenue", "Lane", "Drive", "Court")


def _value(kind: str, r: random.Random) -> str:
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice("aeionrstlm") for _ in range(r.randint(3, 8)))
    if kind in ("word", "Word"):  # a filler that no list holds
        return word() if kind == "word" else word().title()
    if kind == "phone":
        return r.choice([f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)} {d(3)} {d(4)}", f"0{d(2)}/{d(7)}", f"0{d(3)} {d(6)}", f"{d(3)}.{d(3)}.{d(4)}"])
    if kind == "ssn":
        return f"{d(3)}-{d(2)}-{d(4)}"
    if kind == "iban":
        return r.choice(["DE", "FR", "ES", "GB"]) + d(2) + "".join(f" {d(4)}" for _ in range(r.randint(3, 5))) + r.choice(["", f" {d(2)}"])
    if kind == "mail":
        at, dot = r.choice([(" (at) ", " (dot) "), (" [at] ", " [dot] "), (" at ", " dot "), ("(at)", "."), (" at ", ".")])
        return f"{word()}{r.choice(['.', '_', ''])}{word()}{at}{word()}{dot}{r.choice(['com', 'org', 'net', 'de'])}"
    if kind == "passport":
        return r.choice(["", "C"]) + d(9)
    if kind == "street":
        return f"{r.randint(1, 999)} {word().title()} {r.choice(ROADS)}"
    if kind == "digits":
        return d(r.randint(7, 16))
    if kind == "date":
        return r.choice([f"20{d(2)}-0{r.randint(1, 9)}-1{r.randint(0, 9)}", f"1{r.randint(0, 9)}.0{r.randint(1, 9)}.20{d(2)}", f"0{r.randint(1, 9)}/2{r.randint(0, 8)}/20{d(2)}"])
    if kind == "money":
        return r.choice([f"{r.randint(1, 9)} {d(3)} {d(3)} EUR", f"{r.randint(1, 999)} 000 000 USD"])
    if kind == "isbn":
        return f"978-{d(1)}-{d(4)}-{d(4)}-{d(1)}"
    if kind == "scores":
        return f"{r.randint(60, 130)}-{r.randint(60, 130)} {r.randint(60, 130)}-{r.randint(60, 130)}"
    if kind == "range":
        return r.choice([f"19{d(2)}-19{d(2)}", f"{d(4)}-{d(4)}", f"{d(4)}/{d(4)}"])
    if kind == "version":
        return f"{d(2)}.{d(3)}.{d(4)}"
    if kind == "code":
        return r.choice([f"{d(4)}-{d(2)}-{d(6)}", f"AB{d(2)} {word().upper()[:4]:X<4} {d(4)}", f"{d(2)}-{d(2)}-{d(2)}-{d(2)}"])
    if kind == "coords":
        return f"{d(2)}.{d(4)} {d(2)}.{d(4)}"
    return str(r.randint(20, 900))


def passages(which: int, n: int, seed: int) -> list[tuple[int, str, list[tuple[int, int]]]]:
    """(number, text, spans of personal data): n passages of one to three sentences of set `which`."""
    r = random.Random(seed * 3 + which)
    out = []
    for i in range(n):
        text, spans = "", []
        for _ in range(r.randint(1, 3)):
            personal = r.random() < 0.5
            sentence = r.choice((PERSONAL if personal else OTHER)[which])
            while "{" in sentence:
                at, to = sentence.index("{"), sentence.index("}")
                value = _value(sentence[at + 1 : to], r)
                if personal and sentence[at + 1 : to].lower() != "word":
                    spans.append((len(text) + at, len(text) + at + len(value)))
                sentence = sentence[:at] + value + sentence[to + 1 :]
            text += sentence + r.choice([" ", "\n"])
        out.append((i, text, spans))
    return out
