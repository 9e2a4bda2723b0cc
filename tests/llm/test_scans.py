"""License and secret scans against plain readings of their contracts."""

from __future__ import annotations

import hashlib
import random
import re
import string

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tablebridge.llm import licenses, secrets
from tablebridge.llm.licenses import evaluate, label, parse, scan, scan_licenses
from tablebridge.llm.queries import op8_scan_licenses, op9_scan_secrets
from tablebridge.llm.secrets import GRADES, base_spans, choose_thresholds, grade, infer_encoding, randomness, scan_secrets
from tests.conftest import SMALL
from tests.llm.conftest import odd_rows

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def plain_license(text: str | None) -> tuple:
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, name in PHRASES.items():
        own = phrase.split()
        for i in range(len(found) - len(own) + 1):
            if found[i : i + len(own)] == own:
                places.append(i)
                labels.add(name)
    return len(found), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["under", "the", "MIT", "License", "apache", "version", "2", "cc", "BY", "nc", "é", "\u0085", "x"]), max_size=30), st.sampled_from([" ", "-", "\n", ", ", "\x00"]))
def test_base_of_any_words(parts, between):
    text = between.join(parts)
    assert scan(text.encode())[:5] == plain_license(text)


def test_license_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = op8_scan_licenses(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_license(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


def test_expressions():
    assert parse("MIT OR Apache-2.0 AND GPL-3.0-or-later WITH Classpath-exception-2.0") == ["MIT", "Apache-2.0", "GPL-3.0-or-later", "Classpath-exception-2.0", "with", "and", "or"]
    assert parse("(MIT or ISC) and Zlib */ more") == ["MIT", "ISC", "or", "Zlib", "and"]
    assert parse("MIT AND") == ["MIT"]
    assert parse("MIT) x") == ["MIT"]
    assert parse("(MIT") == []
    assert parse("") == parse("OR MIT") == []
    assert evaluate(parse("MIT OR GPL-3.0-only")) == ({"mit", "gpl-3"}, 0.25)
    assert evaluate(parse("MIT AND GPL-3.0-only")) == ({"mit", "gpl-3"}, 0.75)
    assert evaluate(parse("GPL-2.0-or-later WITH Classpath-exception-2.0"))[1] < evaluate(parse("GPL-2.0+"))[1]
    assert [label(x) for x in ("Apache-2.0", "CC-BY-NC-4.0", "GPL-2.0+", "BSD-3-Clause")] == ["apache-2", "cc-by-nc", "gpl-2", "bsd-3-clause"]


def test_tags_and_notices():
    assert scan(b"// SPDX-License-Identifier: (MIT OR Apache-2.0)\ncode")[5:] == ("apache-2,mit", 0.25)
    assert scan(b"GNU General Public License, version 3. All rights reserved.")[5:] == ("gpl-3", 0.75)
    assert scan(b"All rights reserved.")[5:] == ("proprietary", 1.0)
    bsd = b"Copyright. All rights reserved. Redistribution and use in source and binary forms, with or without modification"
    assert scan(bsd)[5:] == ("bsd", 0.25)
    assert scan(b"SPDX-License-Identifier:")[5:] == ("", 0.0)


def test_gpl_file_notices():
    notice = b"""under the terms of the GNU General Public License as published by the Free Software
 * Foundation, either version %d of the License, or (at your option) any later version.
 * See the GNU General Public License for more details."""
    assert scan(notice % 3)[5:] == ("gpl-3", 0.75)
    assert scan(notice % 2)[5:] == ("gpl-2", 0.75)
    assert scan(b"the GNU General Public License as published by the Free Software Foundation; version 2.")[5:] == ("gpl-2", 0.75)
    assert scan(b"the GNU General Public License, see COPYING")[5:] == ("gpl", 0.75)
    assert scan(b"the GNU Lesser General Public License")[5:] == ("lgpl", 0.5)


def test_license_odd_rows(odd, none):
    got = sorted((tuple(r)[:6] for r in scan_licenses(odd).collect()), key=str)
    assert got == sorted(((r[0], *plain_license(r[1])) for r in odd_rows()), key=str)
    assert scan_licenses(none).count() == 0


def plain_secrets(text: str | None) -> list[tuple[int, int, str]]:
    text, found = text or "", []
    assign = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found += [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


PARTS = ["password", "Secret", "api_key", "APIKEY", "token", "toKen", "ſecret", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "deadbeef", "x", "é", "🙂", "\n", "a.b-c/d=="]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25))
def test_base_of_any_parts(parts):
    text = "".join(parts)
    assert sorted(base_spans(text)) == plain_secrets(text)


def check_rows(rows, texts):
    kinds = ["assign", "access", "hex"]
    for r in rows:
        base = plain_secrets(texts[r.doc_id])
        joined = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in base)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == j for _, k, _ in base) for j in range(3))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_secret_query(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op9_scan_secrets(spark, folder).collect()
    assert len(rows) == len(texts)
    check_rows(rows, texts)
    assert any(r.n_hex for r in rows) and any(r.n_assign for r in rows)


def test_secret_odd_rows(odd, none):
    rows = scan_secrets(odd).collect()
    assert len(rows) == len(odd_rows())
    check_rows([r for r in rows if r.doc_id is not None], {r[0]: r[1] for r in odd_rows()})
    assert scan_secrets(none).count() == 0


def test_battery_tells_random_from_text():
    rng = random.Random(5)
    alphabets = ["0123456789abcdef", string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"]
    values = [randomness("".join(rng.choice(a) for _ in range(40))) for a in alphabets for _ in range(80)]
    assert np.mean(np.array(values) > 0.01) > 0.95
    plain = ["configuration_option_number_12_of_the_list", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1", "2024-01-01-2024-01-02-2024-01-03-abc", "abababababababababababababababab12"]
    assert max(map(randomness, plain)) < 0.001


def test_encodings():
    assert infer_encoding("00ff") == secrets.ENCODINGS[0]
    assert infer_encoding("00FF") == secrets.ENCODINGS[1]
    assert infer_encoding("zz9") == secrets.ENCODINGS[3]
    assert infer_encoding("aZ+/==") == secrets.ENCODINGS[5]
    assert infer_encoding("a+-") is None


def test_thresholds_hold_false_finds():
    sums = np.zeros((4, GRADES, 2), np.int64)
    assert (choose_thresholds(sums) == GRADES).all()
    sums[0, :5, 1] = 200
    sums[0, 30:, 0] = 10
    sums[0, :5, 0] = 20
    chosen = choose_thresholds(sums, 0.05)[0]
    assert 5 <= chosen <= 30
    assert grade(0.0) == 0 and grade(1.0) == GRADES - 1


def test_random_tokens_are_found(spark):
    rng = random.Random(9)
    text = [" ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(16, 60))) for _ in range(60)) for _ in range(20)]
    keys = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(40)) for _ in range(30)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(text)] + [(100 + i, f"the value is {k} here") for i, k in enumerate(keys)], "doc_id long, text string")
    rows = {r.doc_id: r.spans for r in scan_secrets(docs).collect()}
    assert sum("random" in rows[100 + i] for i in range(30)) >= 25
    assert not any(rows[i] for i in range(20))


def test_runs_are_cut_where_no_encoding_goes_on():
    a, b = "Ab3dEf6hIj9kLm2nOp", "Zy8xWv5uTs2rQp7oNm"
    assert list(secrets.parts(f"x STRIPE_KEY={a}== y")) == [(13, f"{a}==")]
    assert list(secrets.parts(f"{a}={b}")) == [(0, a), (19, b)]
    assert list(secrets.parts(f"/v1/{a}_-/{b}/tail")) == [(4, f"{a}_-"), (25, b)]
    assert list(secrets.parts(f"{a}/+{b}=")) == [(0, f"{a}/+{b}=")]
    assert list(secrets.parts("=" * 20)) == list(secrets.parts("SHORT_NAME=short_value")) == []


def test_random_values_of_names_and_paths_are_found(spark):
    rng = random.Random(10)
    text = [" ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(16, 60))) for _ in range(60)) for _ in range(20)]
    keys = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(40)) for _ in range(40)]
    forms = ["STRIPE_KEY={}", "AWS_SECRET_ACCESS_KEY={}", "see https://host.example/v1/by-name/{}/get", "at /a_b/{}"]
    docs = [(i, t) for i, t in enumerate(text)] + [(100 + i, forms[i % 4].format(k)) for i, k in enumerate(keys)]
    rows = {r.doc_id: r.spans for r in scan_secrets(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    found = sum(f"random:{docs[20 + i][1].index(k)}:{docs[20 + i][1].index(k) + 40}" in rows[100 + i] for i, k in enumerate(keys))
    assert found >= 34
    assert not any(rows[i] for i in range(20))


def test_phrases_are_those_of_the_contract():
    assert licenses.BASE_PHRASES == PHRASES


def test_very_long_texts_full_of_hits_take_time_in_proportion(spark):
    """Texts of some MB, in one line: places of phrases, tags and spans as in short ones."""
    import time

    own, n = b"Under the MIT License. SPDX-License-Identifier: MIT ", 100_000
    began = time.perf_counter()
    words, hits, first, last, base, labels, _ = scan(own * n)
    assert (words, hits, first, last, base, labels) == (8 * n, n, 0, 8 * n - 8, "mit", "mit")
    docs = [(1, "token=abcdef123 Zq8xK2mVw7RtL4pYbN3c " * n), (2, "nothing")]
    rows = {r.doc_id: r for r in secrets.scan_secrets(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert rows[1].n_assign == n and rows[2].n_assign == 0
    assert time.perf_counter() - began < 60  # minutes if each hit looked at all before it


def test_spans_that_meet_a_covered_one():
    taken = secrets.covered([(5, 0, 9), (7, 2, 12), (20, 1, 30)])
    assert taken == ([5, 20], [12, 30])
    for start, end in [(a, b) for a in range(35) for b in range(a + 1, 36)]:
        assert secrets.is_free(start, end, *taken) == (not (start < 12 and 5 < end or start < 30 and 20 < end))
