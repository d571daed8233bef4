"""Encoding, quality, secrets and exact duplicates."""

from __future__ import annotations

import hashlib
import random
import re
import sys
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from conftest import TESTDATA, rows_of
from llm.edges import clashing, documents, texts
from oracle_check import connect, difference
from pyspark.sql import types as T

from clickloom.llm import quality, secrets
from clickloom.llm import queries as registered
from clickloom.llm.exact import exact_dedup, exact_groups
from clickloom.llm.frames import with_column_of
from clickloom.llm.pieces import PieceModel, decode_pieces, encode_pieces, read_model
from clickloom.llm.quality import features, fit, learn, with_score
from clickloom.llm.secrets import KINDS, find_secrets, spans

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SF = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_pieces_are_those_of_the_library(library):
    model, rng = PieceModel(read_model(MODEL)), random.Random(2)
    pool = ["a", "b", " ", "  ", "▁", "\n", "the", "é", "日", "😀", "\x00", "\t", "123", ".", "<s>", "<0x0A>",
            "ing", "er", "�", "\r\n", "ction", "aaaa", "    "]
    for _ in range(4000):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(40)))
        ids = library.encode(text)
        assert model.encode(text).tolist() == ids, text
        assert model.decode(np.array(ids, np.int32)) == library.decode(ids)
    for _ in range(2000):
        ids = [rng.randrange(32000 if rng.random() < 0.5 else 262) for _ in range(rng.randrange(8))]
        assert model.decode(np.array(ids, np.int32)) == library.decode(ids)


def test_encoding_of_edge_rows(spark, library):
    model = read_model(MODEL)
    docs = clashing(documents(spark))
    out = decode_pieces(encode_pieces(docs, model), model, text="decoded")
    assert out.columns == docs.columns
    found = [(r.text, r.ids, r.decoded) for r in out.collect()]
    assert Counter(t for t, _, _ in found) == Counter(t for _, t in texts())
    for text, ids, decoded in found:
        assert ids == library.encode(text or "") and decoded == library.decode(ids)
    once = encode_pieces(docs, model, decoded="decoded")
    assert once.columns == docs.columns and rows_of(once) == rows_of(out)
    assert encode_pieces(docs.limit(0), model).count() == 0


def test_words_seen_before_are_bounded_by_their_bytes():
    model, rng = PieceModel(read_model(MODEL)), random.Random(3)
    letters = [c for c in sorted(model.known) if c > "\u4e00"][:12]
    for _ in range(120):
        model.encode(" ".join("".join(rng.choices(letters, k=60)) for _ in range(1000)))
        seen = [model.words, model.old_words]
        assert sum(sys.getsizeof(w) + sys.getsizeof(i) for d in seen for w, i in d.items()) < 50_000_000
    assert model.old_words  # more words came than one generation holds


def test_whole_texts_go_to_python_few_at_a_time(spark):
    docs = spark.range(3000, numPartitions=1).selectExpr("id", "CAST(id AS string) AS text")
    at = with_column_of(docs, "text", "at", T.LongType(), lambda a: pa.array([a.offset] * len(a), pa.int64()))
    rows = at.collect()
    assert [r.id for r in rows] == list(range(3000)) and max(r.at for r in rows) < 512


def test_query_of_pieces_on_whole_table(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = []
    for r in rows:
        ids = library.encode(r.text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        text = hashlib.sha256(library.decode(ids).encode()).hexdigest()
        want.append((r.doc_id, len(ids), digest, text))
    assert rows_of(registered.op1_pieces(spark, SF)) == sorted(want, key=repr)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_exact_groups_of_edge_rows(spark):
    docs = documents(spark)
    groups = {}
    for i, t in texts():
        groups.setdefault(lowered(t), []).append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(t.encode()).hexdigest()
        want.update((i, keep, len(ids), i == keep, digest) for i in ids)
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(tuple(r) for r in exact_groups(clashing(docs)).select(columns).collect()) == want
    stay = exact_dedup(clashing(docs))
    assert stay.columns == clashing(docs).columns
    assert Counter(lowered(r.text) for r in stay.collect()) == Counter(list(groups))
    assert exact_groups(docs.limit(0)).count() == exact_dedup(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_queries_against_sql(spark, name):
    problem, _ = difference(spark, connect(f"{TESTDATA}/sf0.01"), f"{TESTDATA}/sf0.01", name)
    assert problem is None


def test_quality_on_held_out_labels(spark):
    sf = f"{TESTDATA}/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = registered.op3_quality(spark, sf).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    right = [r.predicted == label[r.doc_id] for r in rows if r.held_out and r.doc_id in label]
    assert len(right) > 80 and sum(right) / len(right) > 0.97


def test_quality_of_edge_rows(spark):
    docs = clashing(documents(spark))
    labels = spark.createDataFrame(
        [(13, 1), (10, 1), (9, 0), (9, 0), (None, 1), (99, 0), (2, 0), (1, None)], "doc_id bigint, quality int")
    out = with_score(docs, fit(docs, labels))
    assert out.columns == docs.columns and out.count() == len(texts())
    score = {r.doc_id: r.score for r in out.collect()}
    assert score[13] > 0.5 > score[9]
    one = with_score(docs, fit(docs, labels.where("quality = 1")))
    assert {r.score for r in one.collect()} == {0.5}
    assert with_score(docs.limit(0), fit(docs.limit(0), labels)).count() == 0


def test_ranking_puts_the_threshold_between_the_labels():
    x = np.stack([features("plain words here " * 5)] * 5 + [features("WORDS!! HERE!! " * 5)] * 3)
    ranking = learn(x, np.array([1] * 5 + [0] * 3))
    assert (ranking.score(x)[:5] > 0.5).all() and (ranking.score(x)[5:] < 0.5).all()


@pytest.mark.parametrize("per_label", [40, 4000])
def test_the_threshold_comes_from_all_labelled_rows(spark, per_label):
    sf = f"{TESTDATA}/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    ranking = fit(docs, labels, per_label=per_label)
    rows = docs.join(labels.where("quality IN (0, 1)"), "doc_id").collect()
    assert len(rows) > 100
    scores = ranking.raw(np.stack([features(r.text) for r in rows]))
    good = np.array([r.quality == 1 for r in rows])
    assert abs(ranking.threshold - quality._threshold(scores[good], scores[~good])) < 1e-9


@pytest.mark.parametrize("edges", [[], [0.0], list(np.linspace(-3, 4, 40))])
def test_the_threshold_of_a_table_is_that_of_its_rows(spark, edges):
    rng = np.random.default_rng(1)
    for good, bad, apart in ((600, 100, 1.5), (5, 70, 0.0), (9, 1, -9.0), (9, 9, 99.0)):
        x = np.round(rng.normal(apart, 1, good), 1).tolist()
        y = np.round(rng.normal(0, 1, bad), 1).tolist()
        table = spark.createDataFrame(
            [(v, 1) for v in x] + [(v, 0) for v in y], "_raw double, _label int")
        want = quality._threshold(np.array(x), np.array(y))
        assert abs(quality.threshold_of_all(table, np.array(edges)) - want) < 1e-9


def base_spans(text):
    found = []
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(pattern, text, re.I | re.A):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, m.end()))
    for k, pattern, least in ((1, r"AKIA[A-Z0-9]+", 16), (2, r"[0-9a-f]+", 32)):
        found += [(m.start(), k, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(found)


def test_base_spans_are_those_of_the_patterns(spark):
    rng = random.Random(4)
    pool = ["password", "ToKeN", "api_key", "apikey", "passwd", '"', "'", " ", ":", "=", "AKIA", "ABCD1234EFGH",
            "0123456789abcdef", "deadbeef" * 4, "\n", "é", "ſecret", "x", "==", "a/b+c.d_e-f"]
    cases = ["".join(rng.choice(pool) for _ in range(rng.randrange(25))) for _ in range(3000)]
    cases += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for text in cases:
        got = [(s, KINDS.index(k), e) for k, s, e, _ in spans(text) if k != "literal"]
        assert got == base_spans(text), text


@pytest.mark.parametrize("text, literals", [
    ('key = "abcd" + "Efgh1234xyz"\nDB_PASSWORD=key', ["abcd", "Efgh1234xyz"]),
    ("client_secret: 'a8Fj29dkLQm2'", ["a8Fj29dkLQm2"]),
    ('"authToken" => "a8Fj29dkLQm2"', ["a8Fj29dkLQm2"]),
    ("export AUTH_PASS=hunter2hunter3", ["hunter2hunter3"]),
    ("password = ${FROM_ENV}", []), ("password: changeme123", []), ("colour = a8Fj29dkLQm2", []),
    ("see https://host/path?x=a8Fj29dkLQm2", []), ("", []), (None, []),
])
def test_literals_are_found_by_the_names_they_reach(text, literals):
    assert [text[s:e] for k, s, e, _ in spans(text) if k == "literal"] == literals


@pytest.mark.parametrize("text, literals", [
    ("k = " + " + ".join(f"'{c}'" for c in "a8Fj29dkLQm2x7Rt5Vw") + "\npassword = k", [*"a8Fj29dkLQm2x7Rt5Vw"]),
    ("k = 'old8Fj29dkL'\nk = " + " + ".join(f"'{c}'" for c in "a8Fj29dkLQm2x7Rt5Vw") + "\npassword = k",
     [*"a8Fj29dkLQm2x7Rt5Vw"]),
    ("k = 'old8Fj29dkL'\nk = (\npassword = k", []),
    ("self.x = 'a8Fj29dkLQm2'\npassword = self.x", ["a8Fj29dkLQm2"]),
    ("cfg.db = 'a8Fj29dkLQm2'\ncfg = 'b7Gk38elMRn3'\npassword = cfg.db", ["a8Fj29dkLQm2"]),
    ("db-part = 'a8Fj29dkLQm2'\npassword = db-part", ["a8Fj29dkLQm2"]),
])
def test_literals_are_propagated_through_all_names(text, literals):
    assert [text[s:e] for k, s, e, _ in spans(text) if k == "literal"] == literals


SECRET, OTHER = "a8Fj29dkLQm2", "b7Gk38elMRn3"


@pytest.mark.parametrize("text, literals", [
    (f'password = """{SECRET}"""', [SECRET]), (f"password = '''\n{SECRET}'''", ["\n" + SECRET]),
    (f"password = \\\n    '{SECRET}'", [SECRET]), (f"password =\n    '{SECRET}'", [SECRET]),
    (f'"password":\n  "{SECRET}"', [SECRET]),
    (f"password = ('{SECRET[:6]}'\n  '{SECRET[6:]}')", [SECRET[:6], SECRET[6:]]),
    (f"password = '{SECRET[:6]}' \\\n  '{SECRET[6:]}'", [SECRET[:6], SECRET[6:]]),
    (f"password = '{SECRET[:6]}' +\n  '{SECRET[6:]}'", [SECRET[:6], SECRET[6:]]),
    (f"passwords = ['x']\ntoken = ['{SECRET}', '{OTHER}']", [SECRET, OTHER]),
    (f"a:\n  password: |\n    {SECRET}\n  colour: {OTHER}", [SECRET]),
    (f"- password: >-\n    {SECRET[:6]}\n    {SECRET[6:]}\n- x: {OTHER}", [SECRET[:6], SECRET[6:]]),
    (f'os.environ.setdefault("DB_PASSWORD", "{SECRET}")', [SECRET]),
    (f"define('SECRET_KEY', '{SECRET}');", [SECRET]), (f"setdefault('colour', '{SECRET}')", []),
    (f'<property name="db.password" value="{SECRET}"/>', [SECRET]),
    (f'user, password = "{OTHER}", "{SECRET}"', [SECRET]),
    (f'user, password = "{OTHER}", read()\nx = password', []),
    (f'password, x = "{SECRET}", read()', [SECRET]), (f'let user, password = "{SECRET}";', [SECRET]),
    (f'call(\n    user, password="{SECRET}",\n)', [SECRET]), (f'x, password="{SECRET}", b=1', [SECRET]),
    (f"k = '{SECRET}'\npassword = f\"{{k}}\"", [SECRET]),
    (f"k = '{SECRET}'\npassword = f'{OTHER}-{{k}}'", [SECRET, OTHER + "-"]),
    (f"k = '{SECRET}'\npassword = '{{k}}'", []), (f"k = '{SECRET}'\npassword = '${{k}}'", []),
    (f"k={SECRET}\nPASSWORD=${{k}}", [SECRET]), (f"k={SECRET}\nPASSWORD=$k", [SECRET]),
    (f'k={SECRET}\nPASSWORD="$k"', [SECRET]), (f"$k = '{SECRET}';\n$password = \"${{k}}\";", [SECRET]),
    (f"PASSWORD=${{FROM_ENV:-{SECRET}}}", [SECRET]), ("PASSWORD=$k", []),
    (f"<password>{SECRET}</password>", [SECRET]), (f"<db.password id='1'>\n {SECRET}\n</db.password>", [SECRET]),
    (f"<colour>{SECRET}</colour>", []),
    (f'password = "{SECRET[:6]}"\npassword += "{SECRET[6:]}"', [SECRET[:6], SECRET[6:]]),
    (f'char password[] = "{SECRET}";', [SECRET]),
    ("char password[] = {" + ", ".join(f"'{c}'" for c in SECRET) + "};", [*SECRET]),
    (f'password: str = "{SECRET}"', [SECRET]),
    (f"k = '{SECRET}'\n# k = 'x'\npassword = k", [SECRET]), (f"# password = '{SECRET}'", [SECRET]),
    ('class Secret:\n    """Words on what this class is about, a few."""', []),
])
def test_forms_of_assignments(text, literals):
    assert sorted(text[s:e] for k, s, e, _ in spans(text) if k == "literal") == sorted(literals)


@pytest.mark.parametrize("text", [
    "a=(\"x\",\n" * 30_000, "a: |\n" + "".join(" " * (i % 50 + 1) + "b: |\n" for i in range(30_000)),
    'password="""' * 20_000, "x='''a\"\"\"" * 20_000, "(\"a\"," * 50_000, "<a>" * 50_000 + "</a>",
    "a, " * 50_000 + "x=1," * 50_000, "a = $b" + "${b}" * 50_000, "k = f'{k}{k}'\n" * 3_000,
    "password = \\\n" * 30_000, "a='x'+\n" * 30_000, "a = ['b=[', " * 30_000, "a<" * 100_000,
    "a = 1" + " " * 200_000 + "+", "password=\"$a{" * 30_000, "(" + " " * 100_000 + "'a'", "a: b" * 50_000,
    "a['" * 50_000 + "=", "name=" * 50_000, "a " * 100_000 + "=", "<a " * 50_000, "a:b" * 50_000 + " =",
    "a." * 100_000 + "=", "=" * 100_000, "a='\\\n" * 30_000, "a=b+\n" * 30_000 + "c", "a:" + " " * 100_000 + "b",
])
def test_time_grows_with_the_length_of_a_text(text):
    began = time.process_time()
    spans(text)
    assert time.process_time() - began < 5


def test_the_score_of_joined_values_is_that_of_their_text():
    rng = random.Random(6)
    pool = ["a", "x", "X", "xx", "$", "{", "<", ">", "a b", "%", "(", "*", "**", "", "change", "me", "_", "no", "ne1",
            "8Fj2", "9dkLQ", "null", "é", "<a", "b>", "aaaa", "A", " "]
    for _ in range(20_000):
        parts = [rng.choice(pool) for _ in range(rng.randrange(1, 9))]
        values = [secrets.Value(p, 0, 0) for p in parts]
        while len(values) > 1:
            k = rng.randrange(len(values) - 1)
            values[k : k + 2] = [values[k].joined(values[k + 1])]
        assert abs(values[0].randomness() - secrets.literal_score("".join(parts))) < 1e-9, parts


def test_names_that_double_stay_small():
    text = "k = 'a8F'\n" + "k = k + k\n" * 20_000 + "password = k"
    assert [text[s:e] for k, s, e, _ in spans(text) if k == "literal"] == ["a8F"]


def test_secrets_of_edge_rows(spark):
    docs = clashing(documents(spark))
    out = find_secrets(docs)
    assert out.columns == docs.columns and out.where("secrets IS NULL").count() == 0
    assert out.count() == len(texts()) and find_secrets(docs.limit(0)).count() == 0
    long = "a=b:" * 50_000 + 'password="' * 5_000 + "x='" + "\\a" * 50_000
    assert spans(long)
    assert registered.op6_secrets(spark, SF).where("spans IS NULL").count() == 0
