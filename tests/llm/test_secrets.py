"""Secret spans against a plain regex scan, and the models on planted strings."""

import hashlib
import random
import re
from collections import Counter

from cofreq.llm import secrets

ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"""
                    r"""[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def as_text(spans):
    return ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def check(rows, out):
    want = []
    for doc_id, text in rows:
        b = base_spans(text)
        want.append((doc_id, *(sum(k == i for _, k, _ in b) for i in range(3)),
                     hashlib.sha256(as_text(b).encode()).hexdigest()))
    got = [(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows],
                                 "doc_id bigint, text string, spans string, __base int").drop("__base")


def test_whole_table_against_plain_scan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    out = secrets.find_secrets(docs).collect()
    check(rows, out)
    for r in out:
        parts = r.spans.split(",") if r.spans else []
        assert len([p for p in parts if not p.startswith("markov")]) == r.n_assign + r.n_access + r.n_hex


def test_awkward_texts(spark):
    rng = random.Random(1)
    long = " ".join(f"token={rng.getrandbits(64):016x} é𝄞 AKIA{'A1' * 9}" for _ in range(700))
    rows = [(1, None), (2, ""), (2, ""), (None, "PASSWORD='abc123' x"), (3, "password: token: abcdefgh"),
            (4, "𝄞é api_key = \"a.b/c+d-e_\" " + "f" * 24), (5, "AKIA" + "Z" * 15 + " AKIA" + "Z" * 16),
            (6, long), (7, "secret=short secret=longer1"), (8, "0" * 23 + "g" + "0" * 30),
            (9, "ſecret=abcdefgh toKen=abcdefgh")]
    check(rows, secrets.find_secrets(_docs(spark, rows)).collect())


def test_empty_table(spark):
    out = secrets.find_secrets(_docs(spark, []))
    assert out.count() == 0


def test_models_add_random_strings_only(spark):
    rng = random.Random(2)
    alnum = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    names = ["get_user_profile_name", "internationalization", "configuration_manager_factory",
             "representation", "transformation_pipeline", "synchronization_context"]
    samples = [("".join(rng.choice(alnum) for _ in range(32)), 1) for _ in range(300)]
    samples += [(a + "_" + b, 0) for a in names for b in names]
    planted = "".join(rng.choice(alnum) for _ in range(32))
    text = f"call internationalization_context_manager with {planted} now"
    out = secrets.find_secrets(_docs(spark, [(1, text)]),
                               spark.createDataFrame(samples + [(None, 1), ("abc", None)], "value string, label int")).first()
    at = text.index(planted)
    assert out.spans == f"markov:{at}:{at + 32}" and out.n_markov == 1


def test_log_ratio_matches_plain_sum(spark):
    import math
    data = [("aab", 1), ("abab", 1), ("ba-b", 0), ("é1é", 0)]
    ratio = secrets.train(spark.createDataFrame(data, "value string, label int"))
    side = len(secrets.ALPHABET) + 1
    code = lambda c: secrets.ALPHABET.find(c) + 1
    n = {0: {}, 1: {}}
    for v, y in data:
        for a, b in zip(v, v[1:]):
            n[y][code(a), code(b)] = n[y].get((code(a), code(b)), 0) + 1

    def single(y, b):
        return (sum(c for (_, x), c in n[y].items() if x == b) + 1) / (sum(n[y].values()) + side)

    def p(y, a, b):
        return ((n[y].get((a, b), 0) + secrets.BACKOFF * single(y, b))
                / (sum(c for (x, _), c in n[y].items() if x == a) + secrets.BACKOFF))
    for v in ("abba-é1", "x", ""):
        want = sum(math.log(p(1, code(a), code(b)) / p(0, code(a), code(b))) for a, b in zip(v, v[1:]))
        got = spark.createDataFrame([(v,)], "v string").select(secrets.log_ratio(__import__("pyspark").sql.functions.col("v"), ratio)).first()[0]
        assert abs(got - want) < 1e-9


def test_redact(spark):
    hexes = "0123456789abcdef0123456789abcdef"
    rows = [(1, f"token = \"{hexes}\" tail"), (2, "clean text"), (3, None), (4, f"{hexes} {hexes}"), (5, f"é{hexes}")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = {r.doc_id: r for r in secrets.redact(docs).collect()}
    assert secrets.redact(docs).schema == docs.schema
    assert out[1].text == "[SECRET]\" tail" and out[1].n_chars == len(out[1].text)
    assert out[2].text == "clean text" and out[3].text is None
    assert out[4].text == "[SECRET] [SECRET]" and out[5].text == "é[SECRET]"


def test_pieces_and_short_tokens(spark):
    rng = random.Random(5)
    alnum = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    words = ("get the user profile name of international configuration manager factory customer reports annual "
             "download archive transformation pipeline synchronization context year 2024 2025 page12 mail3").split()
    key = lambda n: "".join(rng.choice(alnum) for _ in range(n))
    samples = [(key(32), 1) for _ in range(400)]
    samples += [(a + sep + b, 0) for a in words for b in words for sep in "/_-="]
    path, hexes = "/customer/reports/annual/download/archive/", "0123456789abcdef" * 2
    texts, want = [], []
    for i in range(30):
        k, l, short = key(24), key(24), key(15)
        texts.append(f"see {path}{k} and {path}{k}{path}{l}/page12 or {short}, {path}{hexes}/{l}")
        want.append([k, k, l, short, l])
    texts.append(f"see {path} mail3 page12 of get_user_profile-2024-2025 " * 20)
    want.append([])
    rows = list(enumerate(texts))
    out = secrets.find_secrets(_docs(spark, rows), spark.createDataFrame(samples, "value string, label int")).collect()
    check(rows, out)
    missed = 0
    for r in out:
        text = texts[r.doc_id]
        spans = [p.split(":") for p in r.spans.split(",") if p.startswith("markov")]
        got = [text[int(a):int(b)] for _, a, b in spans]
        if not want[r.doc_id]:
            assert not got
        # every random string is found; an ordinary path is never part of a span from end to end
        missed += sum(not any(w in g for g in got) for w in want[r.doc_id])
        assert len(got) <= 5 and not any(path in g for g in got)
    assert missed == 0


def plain_samples(texts):
    """Distinct base values, and the other tokens with the number of texts that hold them."""
    values, plain = set(), Counter()
    for t in texts:
        t = t or ""
        values |= {m[2] for m in ASSIGN.finditer(t) if len(m[2]) >= 6}
        values |= {m[0] for m in re.finditer(secrets.ACCESS, t)} | {m[0] for m in re.finditer(secrets.HEX, t)}
        rest = ASSIGN.sub(" ", t) if base_spans(t) else t
        plain.update({v for v in re.findall(secrets.TOKEN, rest) if not re.search(f"{secrets.HEX}|{secrets.ACCESS}", v)})
    return Counter({**{(v, 1): 1 for v in values}, **{(v, 0): n for v, n in plain.items()}})


def test_models_learn_from_all_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = Counter({(r.value, r.label): r.n for r in secrets.own_samples(docs).collect()})
    assert got == plain_samples(r.text for r in docs.select("text").collect())
    # however many copies one text has, the tokens of the others count
    rows = [(i, "only one text again and again") for i in range(600)] + [(1000, "other_word token=abcdef12"), (1001, None)]
    got = {(r.value, r.label): r.n for r in secrets.own_samples(_docs(spark, rows)).collect()}
    assert got["again", 0] == 600 and got["other_word", 0] == 1 and got["abcdef12", 1] == 1
    # a weight counts as so many rows
    samples = [("abc", 0), ("abc", 0), ("xyz", 1)]
    assert secrets.train(spark.createDataFrame(samples, "value string, label int")) == secrets.train(
        spark.createDataFrame([("abc", 0, 2), ("xyz", 1, 1)], "value string, label int, n long"))


def plain_markov(text, ratio, threshold=secrets.THRESHOLD):
    side = len(secrets.ALPHABET) + 1
    base = [(s, e) for s, _, e in base_spans(text)]

    def steps(v):
        codes = [secrets.ALPHABET.find(c) + 1 for c in v]
        return [ratio[a * side + b] for a, b in zip(codes, codes[1:])]

    def free(s, e):
        return not any(b < e and s < f for b, f in base)
    out = []
    for m in re.finditer(secrets.TOKEN, text or ""):
        v, at = m[0], m.start()
        if not re.search("[A-Za-z]", v):
            continue
        if sum(steps(v)) >= threshold and free(at, m.end()):
            out.append((at, m.end()))
            continue
        # groups of neighbouring pieces that no base span touches
        open_, start, end, total, high = False, 0, 0, 0.0, 0.0
        found = []
        for p in re.finditer(secrets.PART, v):
            n = len(re.match(secrets.PIECE, p[0])[0])
            s, e = at + p.start(), at + p.start() + n
            inner = sum(steps(v[p.start():p.start() + n]))
            if n and free(s, e) and open_ and total >= 0 and not (high >= threshold and high - total - inner >= threshold):
                total += inner
                if total > high:
                    high, end = total, e
            else:
                if open_ and high >= threshold:
                    found.append((start, end))
                open_, start, end, total, high = bool(n) and free(s, e), s, e, inner, inner
            total += sum(steps(v[p.start():p.end() + 1])) - inner
        if open_ and high >= threshold:
            found.append((start, end))
        out += [(s, e) for s, e in found if re.search("[A-Za-z]", text[s:e])]
    return out


def test_markov_spans_of_a_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rng = random.Random(8)
    alnum = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    key = lambda n: "".join(rng.choice(alnum) for _ in range(n))
    more = [(10 ** 6 + i, f"see /some/path/{key(24)}/of/{key(9)}-{key(16)} and {key(rng.randint(4, 30))} {key(20)}=token: {key(12)}")
            for i in range(60)]
    docs = docs.unionAll(spark.createDataFrame(more, "doc_id bigint, text string"))
    ratio = secrets.train(secrets.own_samples(docs))
    texts = {r.doc_id: r.text for r in docs.collect()}
    n = 0
    for r in secrets.find_secrets(docs).collect():
        got = [tuple(map(int, p.split(":")[1:])) for p in r.spans.split(",") if p.startswith("markov")]
        assert got == plain_markov(texts[r.doc_id], ratio), r.doc_id
        n += len(got)
    assert n > 100


def test_a_text_of_many_secrets(spark):
    """A long text has the spans of its lines, and each line's places; long
    lists of random tokens and base spans of every kind are in it."""
    import string
    rng = random.Random(4)
    signs = string.ascii_letters + string.digits

    def word(n, of=signs):
        return "".join(rng.choices(of, k=n))

    def line(i):
        return [f"plain words {word(30)} and password = {word(20)}", f"token={word(24, '0123456789abcdef')} words",
                f"AKIA{word(18, string.ascii_uppercase)} plain {word(28)}/words/{word(26)}",
                f"{word(30, '0123456789abcdef')} plain {word(25)}"][i % 4]

    samples = spark.createDataFrame(
        [(word(24), 1) for _ in range(200)] + [(w, 0) for w in "plain words and token password".split()] * 50,
        "value string, label int")
    lines = [line(i) for i in range(160)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(lines)] + [(-1, " ".join(lines))], "doc_id bigint, text string")
    out = {r.doc_id: r.spans for r in secrets.find_secrets(docs, samples).collect()}
    want, at = [], 0
    for i, text in enumerate(lines):
        for one in out[i].split(","):
            kind, start, end = one.split(":")
            want.append(f"{kind}:{int(start) + at}:{int(end) + at}")
        at += len(text) + 1
    assert sum(x.startswith("markov") for x in want) > 100
    assert out[-1] == ",".join(want)
