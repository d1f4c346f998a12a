import hashlib
import random
import re
import string

from fathomline.llm import secrets

KEY = "Zx9Kq2Lm8Vw4Tn7Rb1Yc6Hd3Pf5Gs0Jt"
TEXTS = [
    None,
    "",
    'password = "hunter22" and token: abc and API_KEY=abcdef api-key=zzzzzzz',
    "secret: token = abcdefgh",
    "AKIA" + "A1" * 8 + " AKIA123 " + "AKIAAKIA" + "B2" * 10,
    "hash " + "0123456789abcdef" * 2 + " short 0123456789abcdef ß" + "f" * 24,
    f"the signing key for the service is {KEY} please rotate",
    "the signing key for the service is get_default_connection_timeout_value2 please",
    "ſecret = aaaaaaaa paſſword = aaaaaaaa Key",
    "x" * 200_000 + " token=" + "a" * 50_000,
]


def base(text):
    """Character by character, without the patterns' search."""
    text, found = text or "", []
    words = ("password", "passwd", "secret", "token", "api_key", "apikey")
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    i = 0
    while i < len(text):
        word = next((w for w in words if lower.startswith(w, i)), None)
        j = i + len(word) if word else i
        if word:
            j += text[j : j + 1] in ("'", '"') and text[j : j + 1] != ""
            while text[j : j + 1] == " ":
                j += 1
            if text[j : j + 1] in (":", "=") and text[j : j + 1]:
                j += 1
                while text[j : j + 1] == " ":
                    j += 1
                j += text[j : j + 1] in ("'", '"') and text[j : j + 1] != ""
                k = j
                while k < len(text) and text[k] in string.ascii_letters + string.digits + "+/_.=-":
                    k += 1
                if k > j:
                    if k - j >= 6:
                        found.append((i, 0, f"assign:{i}:{k}"))
                    i = k
                    continue
        i += 1
    for kind, order, lead, letters, least in (("access", 1, "AKIA", string.ascii_uppercase + string.digits, 20), ("hex", 2, "", "0123456789abcdef", 24)):
        i = 0
        while i < len(text):
            k = i + len(lead)
            if text.startswith(lead, i):
                while k < len(text) and text[k] in letters:
                    k += 1
                if k > i + len(lead):
                    if k - i >= least:
                        found.append((i, order, f"{kind}:{i}:{k}"))
                    i = k
                    continue
            i += 1
    return [s for _, _, s in sorted(found)]


def test_base_spans_equal_brute_force(docs_of):
    r = random.Random(5)
    bits = ["password", "token", "secret", "apikey", "API_KEY", "AKIA", " ", "=", ":", '"', "abc123", "deadbeef0123", "QWERTY99", "é", "\n", "-", "."]
    texts = TEXTS + ["".join(r.choice(bits) for _ in range(r.randrange(5, 80))) for _ in range(300)]
    out = {x["doc_id"]: x for x in secrets.op1_secret_scan(docs_of(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        want = base(t)
        assert out[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), (t, want, out[i]["spans"])
        assert [s for s in out[i]["spans"].split(",") if s and not s.startswith("novel")] == want
        assert [out[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex")]


def test_novel_strings(docs_of):
    out = {r["doc_id"]: r for r in secrets.find_secrets(docs_of(list(enumerate(TEXTS)))).collect()}
    novel = [(TEXTS[i][s["start"] : s["end"]]) for i, r in out.items() for s in r["secrets"] if s["kind"] == "novel"]
    assert novel == [KEY]
    assert out[0]["secrets"] == [] and out[1]["secrets"] == []


def test_all_strings_of_a_context(docs_of):
    """Several strings after a word, before it, on the next line, without a digit."""
    other, letters = "p0QzT7vXe2LkWm9RbN4c", "QzTvXeLkWmRbNcYhGdJs"
    texts = [
        f"credential my-production-database-1 {KEY}",
        f"secret keys: {KEY} {other}",
        f"the password is on the next line\n{KEY}\n",
        f"{KEY} is the secret",
        f"bearer {letters}",
        "secret of the my-production-database-1 and get_default_connection_timeout_value2 and DefaultConnectionHandlerFactory",
        f"no such word here {KEY}",
    ]
    out = {r["doc_id"]: r for r in secrets.find_secrets(docs_of(list(enumerate(texts)))).collect()}
    got = [[texts[i][s["start"] : s["end"]] for s in out[i]["secrets"] if s["kind"] == "novel"] for i in range(len(texts))]
    assert got == [[KEY], [KEY, other], [KEY], [KEY], [letters], [], []]


def novel_by_pairs(text, primed):
    """Every string against every sensitive word and every base span."""
    spans = secrets.base_spans(text)
    words = list(secrets.SENSITIVE.finditer(text))
    found = []
    for m in re.finditer("[A-Za-z0-9+/_=-]+", text):
        gap = min((max(w.start() - m.end(), m.start() - w.end(), 0) for w in words), default=10**9)
        if len(m.group()) < 8 or gap > secrets.REACH or any(s < m.end() and m.start() < e for _, s, e, _ in spans):
            continue
        left, right = text[: m.start()][-secrets.AROUND :], text[m.end() :][: secrets.AROUND]
        none, plain, fold = (len(primed.compress((left + t + right).encode())) for t in ("  ", f" {m.group()} ", f" {secrets.folded(m.group())} "))
        n = len(m.group())
        if plain - none >= max(13, 0.9 * n) and fold - none >= max(13, 0.8 * n):
            found.append((m.start(), m.end()))
    return found


def test_novel_equals_brute_force():
    r = random.Random(8)
    primed = secrets.encoder()
    bits = ["password", "token=", "secret", "credential", " ", " ", "\n", "AKIA", "default_timeout_handler", "connection", "deadbeef" * 4, "the words of a sentence "]
    for _ in range(150):
        parts = [r.choice(bits) if r.random() < 0.8 else "".join(r.choices(string.ascii_letters + string.digits, k=r.randrange(6, 40))) for _ in range(r.randrange(3, 40))]
        text = " ".join(parts)
        assert [(s, e) for _, s, e, _ in secrets.novel_spans(text, secrets.base_spans(text), primed)] == novel_by_pairs(text, primed)


def test_recall_and_precision():
    """Planted keys are found, identifiers are left alone."""
    r = random.Random(9)
    primed = secrets.encoder()
    names = [w for w in secrets.IDENTIFIERS.split() if w.isalpha() and w.islower() and len(w) > 2]
    prose = "we moved the service to another region last week and wrote down what each of the teams has to change in its own settings "

    def found(middle):
        text = f"{prose}the signing key {middle} was kept {prose}"
        return any(text[s:e] == middle for _, s, e, _ in secrets.novel_spans(text, secrets.base_spans(text), primed))

    keys = ["".join(r.choices(string.ascii_letters + string.digits, k=r.randrange(16, 48))) for _ in range(200)]
    idents = [r.choice(["_", "-"]).join(r.sample(names, r.randrange(2, 5))) + r.choice(["", "1", "_v2"]) for _ in range(100)]
    idents += ["".join(w.title() for w in r.sample(names, r.randrange(2, 5))) for _ in range(100)]
    assert sum(map(found, keys)) >= 0.95 * len(keys)
    assert sum(map(found, idents)) <= 0.05 * len(idents)


def test_empty_table(docs_of):
    assert secrets.find_secrets(docs_of([])).count() == 0
    assert re.search("secrets", str(secrets.find_secrets(docs_of([])).columns))
