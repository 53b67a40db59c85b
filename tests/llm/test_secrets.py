import hashlib
import math
import random
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
from data import documents, prose  # noqa: E402

from taskspire.llm import secrets as S  # noqa: E402

ASSIGN = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_base(spark):
    r = random.Random(4)
    bits = ["token = \"%s\"", "API_KEY:%s", "apikey='%s", "password=a", "Secret  : %s", "AKIA%s", "AKIAAKIA%s", "token=key: token=%s", "%s", "passwd==%s", "tokentoken=%s=", "api_keytoken:abcdefg", "\U0001f600é token=%s"]
    texts = [None, "", "AKIA", "token=" * 50 + "x"]
    for _ in range(150):
        parts = [prose(r, r.randint(0, 8))]
        for _ in range(r.randint(0, 4)):
            b = r.choice(bits)
            parts.append(b % r.choice(("ab12", "deadbeef" * 4, "ABCDEFGH23456789XYZ", "a1b2c3d4e5f60718293a4b5c", "x" * 6)) if "%s" in b else b)
        texts.append(r.choice((" ", "", "\n")).join(parts))
    got = {x["doc_id"]: x for x in S.scan(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        want = base(t)
        assert ",".join(s for s in got[i]["spans"].split(",") if s and not s.startswith("random")) == want, t
        assert got[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in S.KINDS[:3]] == [want.count(k + ":") for k in S.KINDS[:3]]


def test_random_tokens(spark):
    r = random.Random(12)
    b62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    secret = ["".join(r.choices(b62, k=40)) for _ in range(60)] + ["".join(r.choices("0123456789abcdef", k=32)) for _ in range(20)]
    plain = ["internationalization" * 2, "some_long_identifier_name_in_code", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "----------------------------", "path/to/some/ordinary/file/name", "ABCDEFGHIJKLMNOPQRSTUVWXYZABCD", "0123456789" * 3, "abababababababababababababab1212121212"]
    texts = [f"see {t} here" for t in secret] + [f"see {t} here" for t in plain * 20] + [prose(r, 30) for _ in range(50)]
    got = {x["doc_id"]: x for x in S.scan(documents(spark, texts)).collect()}
    hit = lambda i: "random" in got[i]["spans"]
    assert sum(hit(i) for i in range(len(secret))) >= 0.9 * len(secret)
    assert sum(hit(i) for i in range(len(secret), len(texts))) == 0


def brute_battery(token):
    """n, encoding, the three z-values, log_random and log_text in plain Python."""
    body = re.sub("=+$", "", token) or token
    name, alphabet = next(((x, y) for x, pattern, y in S.ENCODINGS if re.search(pattern, body)), ("mixed", S.ANY_ALPHABET))
    n, k = len(body), len(alphabet)
    x = [alphabet.index(c) + 1 for c in body]
    chi = max(0.0, sum(body.count(c) ** 2 for c in alphabet) * k / n - n) / (k - 1)
    ninth = 2 * max(n - 1, 1) / (9 * (k - 1) * n)
    z_chi = (chi ** (1 / 3) - (1 - ninth)) / ninth**0.5
    side = [c > k // 2 for c in x]
    n1, runs = sum(side), 1 + sum(a != b for a, b in zip(side, side[1:], strict=False))
    both = 2 * n1 * (n - n1)
    spread = both * (both - n) / (n * n * max(n - 1, 1))
    z_runs = (runs - both / n - 1) / spread**0.5 if spread > 0 else 99.0
    mean = sum(x) / n
    variance = sum((c - mean) ** 2 for c in x)
    z_serial = (sum((a - mean) * (b - mean) for a, b in zip(x, x[1:], strict=False)) / variance + 1 / n) * n**0.5 if variance > 1e-9 else 99.0
    h = -sum(math.log(max(math.erfc(abs(z) / 2**0.5), 1e-320)) for z in (z_chi, z_runs, z_serial))
    log_random = (math.log(1 + h + h * h / 2) - h) / math.log(10)
    kind = lambda c: "u" if c in S.UPPER else "l" if c in S.LOWER else "d" if c in S.DIGITS else "s"
    p, before = math.log(0.25), None
    for c in body:
        if before:
            p += math.log(S.TEXT_CHANGE / 3 if kind(c) != kind(before) else 1 - S.TEXT_CHANGE)
        if kind(c) == "s":
            p += math.log(0.2)
        elif kind(c) != "d":
            p += math.log(S.LETTERS[ord(c.lower()) - 97] / sum(S.LETTERS))
        elif before is None or kind(before) != "d":
            p += math.log(0.1)
        else:
            gap = abs(int(c) - int(before))
            p += math.log(S.SAME_DIGIT if gap == 0 else S.NEXT_DIGIT / 2 if gap == 1 else (1 - S.SAME_DIGIT - S.NEXT_DIGIT) / 7)
        before = c
    return n, name, z_chi, z_runs, z_serial, log_random, min(0.0, (p + n * math.log(k)) / math.log(10))


def odd_tokens(r):
    classes = (S.DIGITS, S.LOWER, S.UPPER, S.DIGITS + "abcdef", S.UPPER + S.LOWER + S.DIGITS, S.UPPER + S.LOWER + S.DIGITS + "+/", S.ANY_ALPHABET)
    out = ["".join(r.choices(c, k=r.randint(20, 70))) for c in classes for _ in range(25)]
    return out + ["a" + "=" * 19, "=" * 30, "a" * 25, "0123456789" * 3, "Zz9" * 10 + "==", "internationalization", "ab" * 12, "some_long_name_in_code", "x" * 300 + "Q7" * 90]


def test_battery_against_brute_force(spark):
    tokens = odd_tokens(random.Random(3))
    got = {x["token"]: x for x in S.battery(spark.createDataFrame([(t,) for t in tokens], "token string")).collect()}
    for t in tokens:
        x, want = got[t], brute_battery(t)
        assert (int(x["n"]), x["encoding"]) == want[:2]
        for c, w in zip(("z_chi", "z_runs", "z_serial", "log_text"), (*want[2:5], want[6]), strict=True):
            assert abs(x[c] - w) < 1e-6 * max(1, abs(w)), (t, c)
        if want[5] > -20:
            assert abs(x["log_random"] - want[5]) < 0.02 * max(1, -want[5]), t


def brute_step_up(rows):
    """Which of (key, n, log_p) are rejected: within a class of length, ranked by the upper end of their histogram cell."""
    out = set()
    for stratum in {int(math.log2(n)) for _, n, _ in rows}:
        own = [(math.floor(max(p, S.FLOOR) / S.STEP), key) for key, n, p in rows if int(math.log2(n)) == stratum]
        limit = max((c for c, _ in own if (c + 1) * S.STEP <= math.log10(S.FDR * sum(d <= c for d, _ in own) / len(own))), default=None)
        out |= {key for c, key in own if limit is not None and c <= limit}
    return out


def test_random_spans_against_brute_force(spark):
    tokens = sorted(set(odd_tokens(random.Random(5))))
    docs = documents(spark, [f"é see {t} here" for t in tokens])
    # the battery's own figures; the test above holds them against plain Python
    tested = [(x["token"], x["n"], x["log_random"], x["log_text"]) for x in S.battery(spark.createDataFrame([(t,) for t in tokens], "token string")).collect()]
    gone = brute_step_up([(t, n, p) for t, n, p, _ in tested])
    want = brute_step_up([(t, n, p) for t, n, _, p in tested if t not in gone])
    got = {x["doc_id"]: x["spans"] for x in S.scan(docs).collect()}
    for i, t in enumerate(tokens):
        assert (f"random:6:{6 + len(t)}" in got[i].split(",")) == (t in want), t


def test_each_encoding_is_found(spark):
    r = random.Random(9)
    alphabets = {"decimal": S.DIGITS, "lower": S.LOWER, "upper": S.UPPER, "hex": S.DIGITS + "abcdef", "base62": S.UPPER + S.LOWER + S.DIGITS}
    tokens = [(name, "".join(r.choices(a, k=48))) for name, a in alphabets.items() for _ in range(40)]
    texts = [f"see {t} here" for _, t in tokens] + [f"see {t} here" for t in ("internationalization" * 2, "donaudampfschifffahrtsgesellschaftskapitaen", "0123456789" * 4, "ABCDEFGHIJKLMNOPQRSTUVWXYZ" * 2)]
    found = {x["doc_id"] for x in S.scan(documents(spark, texts)).where("n_random > 0").collect()}
    for name in alphabets:
        assert sum(i in found for i, (e, _) in enumerate(tokens) if e == name) >= 36, name
    assert not [i for i in found if i >= len(tokens)]


def test_no_python(spark, small):
    plan = S.op8_secret_scan(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
