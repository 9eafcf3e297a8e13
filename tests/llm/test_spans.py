import hashlib
import math
import random
import re
import time

import public_tokenizers
import pytest

from skein.llm import deobfuscate, guess_cost

from .messy import messy, messy_rows

WORDS = public_tokenizers.path("word_bpe_49k.json")


def luhn(digits):
    total = 0
    for at, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + at % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def digits_of(text):
    return re.sub("[^0-9]", "", text)


def brute_personal(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 14 <= len(digits_of(m[0])) <= 19 and luhn(digits_of(m[0]))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                  if 10 <= len(digits_of(m[0])) <= 15]


def brute_secrets(text):
    out = [("assign", *m.span()) for m in re.finditer(
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return out + [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]


def test_plain_personal_data_against_patterns():
    draw = random.Random(3)
    for _ in range(20_000):
        text = "".join(draw.choices("aZ0123456789..@@--++ ()_%é,５", k=draw.randint(0, 60)))
        assert deobfuscate.plain_spans(text) == brute_personal(text)


def test_plain_secrets_against_patterns():
    draw = random.Random(4)
    parts = ["password", "Token", "api_key", "APIKEY", "secret", "passwd", " ", "=", ":", '"', "'", "abc123", "x/y+z", "AKIA",
             "ABCDEFGH12", "0123456789ab", "deadbeef", "é", "\n"]
    for _ in range(20_000):
        text = "".join(draw.choices(parts, k=draw.randint(0, 14)))
        assert guess_cost.plain_spans(text) == brute_secrets(text)


@pytest.mark.parametrize("text, kind, part", [
    ("mail john dot smith at example dot com now", "email", "john dot smith at example dot com"),
    ("see jane [at] example [dot] org.", "email", "jane [at] example [dot] org"),
    ("x(at)example(dot)co(dot)uk!", "email", "x(at)example(dot)co(dot)uk"),
    ("by jоhn@exаmple.com ok", "email", "jоhn@exаmple.com"),
    ("jane＠example．org", "email", "jane＠example．org"),
    ("info arroba empresa punto es", "email", "info arroba empresa punto es"),
    ("x @ example.com", "email", "x @ example.com"),
    ("call plus one five five five two one two three four five six seven ok", "phone",
     "plus one five five five two one two three four five six seven"),
    ("+１ ５５５ ２１２ ３４５６!", "phone", "+１ ５５５ ２１２ ３４５６"),
    ("four one one one one one one one one one one one one one one one.", "card",
     "four one one one one one one one one one one one one one one one"),
    ("4111​1111​1111​1111", "card", "4111​1111​1111​1111"),
    ("to 192[.]168[.]1[.]1 now", "ip", "192[.]168[.]1[.]1"),
    ("one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
])
def test_disguises_are_mapped_back(text, kind, part):
    for before in ("", "é\U0001F469 日​ "):
        base, added = deobfuscate.Finder().spans(before + text)
        assert [(k, (before + text)[s:e]) for k, s, e in added] == [(kind, part)]
        assert base == brute_personal(before + text)


@pytest.mark.parametrize("text", [
    "we met at noon near the dot of the map", "one two three, he said", "john at gmail.com", "10 m² and 5 ½",
    "mail a@b.example and +1 (555) 212-3456 plain", "the price @ 5.99 is fine", "Él está en la punto"])
def test_clean_texts_get_nothing_added(text):
    base, added = deobfuscate.Finder().spans(text)
    assert added == [] and base == brute_personal(text)


@pytest.fixture(scope="module")
def secrets():
    return guess_cost.Finder(guess_cost.word_ranks(WORDS))


@pytest.mark.parametrize("text, part", [
    ("The password is hunter2, ok", "hunter2"), ("pwd: Tr0ub4dor&3", "Tr0ub4dor&3"), ("passwd=\"abc12\" x", "abc12"),
    ("https://bob:s3cr3tPw@host/x", "s3cr3tPw"), ("Authorization: Bearer eyJhbGciOi.J9xx12", "eyJhbGciOi.J9xx12"),
    ("contraseña: Qw7rty99x", "Qw7rty99x")])
def test_costly_values_in_context(secrets, text, part):
    found = secrets.spans(text)
    assert [(k, text[s:e], new) for k, s, e, new, _ in found] == [("assign", part, True)]


@pytest.mark.parametrize("text", ["password is wrong", "the token is valid", "password: ********", "pass the salt please",
                                  "el token es válido", "Password: required"])
def test_prose_in_context_is_no_secret(secrets, text):
    assert [x for x in secrets.spans(text) if x[3]] == []


@pytest.mark.parametrize("text, part", [
    ("pwd: qzvkxwjpth", "qzvkxwjpth"), ("the passphrase is xkqjzvbwpt.", "xkqjzvbwpt"), ("bearer QZVKXWJPTHMB", "QZVKXWJPTHMB"),
    ("pin code: Wqxzkvjbnt ok", "Wqxzkvjbnt")])
def test_random_letters_in_context(secrets, text, part):
    assert [(k, text[s:e], new) for k, s, e, new, _ in secrets.spans(text)] == [("assign", part, True)]


@pytest.mark.parametrize("text", [
    "credentials required", "the passphrase is unavailable", "pwd: administrator", "bearer authentication", "Passwort vergessen",
    "mot de passe obligatoire", "contraseña incorrecta", "PASSWORD REQUIRED", "token 这是一个非常长的句子"])
def test_words_in_context_are_no_secrets(secrets, text):
    assert [x for x in secrets.spans(text) if x[3]] == []


def test_costs_follow_the_patterns(secrets):
    cost = secrets.guess.cost
    assert cost("qwertyuiop") < cost("qwzrtpuiop") and cost("aaaaaaaa") < cost("aebcadfh")
    assert cost("2019-05-12") < cost("8319-75-62") and cost("password") < cost("P4ssw0rd") < cost("xK9$vQ2!")
    assert cost("") == 0 and cost("x" * 5000) < cost("xK9$vQ2!" * 625)


def test_no_segmentation_is_cheaper(secrets):
    """The least over all ways to cut a value in two, each part by itself, is never below the cost of the whole."""
    cost = secrets.guess.cost
    for value in ("hunter2", "iloveyou1990", "abc123qwerty", "Summer2019!", "xyzzy77"):
        for at in range(1, len(value)):
            assert cost(value) <= cost(value[:at]) + cost(value[at:]) + 1e-9


def test_long_values_are_not_cut(secrets):
    cost = secrets.guess.cost
    for name in ("Token", "Credentials"):
        for rule in ("-" * 60, "-" * 65, "=" * 400):
            assert [x for x in secrets.spans(f"{name}\n{rule}\nand so on") if x[3]] == []
    assert cost("-" * 100) == pytest.approx(math.log10(33) + 2 + math.log10(2))
    assert cost("abc-" * 40) == pytest.approx(cost("abc-" * 4) + 1)
    for before in range(56, 64):
        assert cost("-" * before + "password") <= cost("-" * before) + cost("password") + 1e-9
    walk = "qwertyuiop" + "oiuytrewq" + ("wertyuiop" + "oiuytrewq") * 4
    assert cost(walk) <= math.log10(47) + len(walk) * math.log10(2) + 1e-9


@pytest.mark.parametrize("module, brute", [(deobfuscate, brute_personal), (guess_cost, brute_secrets)])
def test_messy_table(spark, module, brute):
    extra = [] if module is deobfuscate else [WORDS]
    rows = deobfuscate.digest(module.find(messy(spark), *extra), module.KINDS).collect()
    assert len(rows) == len(messy_rows())
    for row, text in zip(sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id)),
                         [t for k, t, *_ in sorted(messy_rows(), key=lambda r: (r[0] is None, r[0]))]):
        plain = sorted(brute(text or ""), key=lambda x: (x[1], module.KINDS.index(x[0])))
        assert [row[f"n_{k}"] for k in module.KINDS] == [sum(x[0] == k for x in plain) for k in module.KINDS]
        assert row.base_sha256 == hashlib.sha256(",".join("%s:%d:%d" % x for x in plain).encode()).hexdigest()
    assert module.find(messy(spark, 0), *extra).collect() == []


def exhaustive(guess, value):
    """Least sum over all ways to cut a value into segments, each priced on its own."""
    date = (r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])", r"(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\1(?:19|20)?\d\d",
            r"(?:0[1-9]|1[0-2])([-/._]?)(?:0[1-9]|[12]\d|3[01])\1(?:19|20)?\d\d")

    def price(part):
        options = [sum(map(guess.per_character, part))]
        lower, plain, n = part.lower(), part.lower().translate(guess_cost.LEET), len(part)
        if 3 <= n <= guess_cost.WORD_LENGTH:
            capitals = math.log10(2) * (part != lower)
            form, more = (lower, 0) if guess.ranks.get(lower) else (plain, math.log10(2))
            if guess.ranks.get(form):
                options.append(math.log10(guess.ranks[form]) + more + capitals)
        if re.fullmatch(r"(?:19|20)\d\d", part):
            options.append(math.log10(150))
        if any(re.fullmatch(form, part) for form in date):
            options.append(math.log10(365 * 150))
        for size in range(1, min(guess_cost.UNIT_LENGTH, n // 2) + 1):
            if n % size == 0 and part == part[:size] * (n // size):
                options.append(guess.unit_cost(part[:size]) + math.log10(n // size))
        keys = lower.translate(guess_cost.SHIFTED)
        if n >= 3 and all(b in guess.near.get(a, ()) for a, b in zip(keys, keys[1:])):
            options.append((n - 1) * math.log10(2) + math.log10(47))
        return min(options) + math.log10(2)

    best = [0.0]
    for end in range(1, len(value) + 1):
        best.append(min(best[start] + price(value[start:end]) for start in range(end)))
    return best[-1]


def test_the_cost_is_the_least_of_all_cuts(secrets):
    draw, pieces = random.Random(11), ["2019", "123123", "20190102", "0102", "31-12-99", "abc", "password", "Summer", "qwerty", "p4ss", "zz", "7", "#", "lol"]
    values = ["2019123123", "1201201999", "20201231122020"] + ["".join(draw.choice(pieces) for _ in range(draw.randint(1, 4))) for _ in range(400)]
    for value in values:
        assert secrets.guess.cost(value) == pytest.approx(exhaustive(secrets.guess, value), abs=1e-9), value


def test_odd_texts_neither_fail_nor_stall(secrets):
    start = time.time()
    assert deobfuscate.plain_spans("1.2.3." + "9" * 5000) == []
    assert deobfuscate.plain_spans("see 1.2.3." + "0" * 5000 + "7 now")[0][0] == "ip"
    plain = guess_cost.Finder(secrets.guess.ranks, plain_costs=False)
    assert [s[:3] for s in plain.spans("token = " + "-" * 200_000)] == [("assign", 0, 200_008)]
    assert time.time() - start < 5
