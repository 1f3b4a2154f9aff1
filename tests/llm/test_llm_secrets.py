"""Secrets that must be found wherever and however often they stand."""

import random
import string

import pytest

from clicksieve.llm import secret_scan

BASE64 = string.ascii_letters + string.digits + "+/"


def key(seed, n=40, alphabet=BASE64):
    return "".join(random.Random(seed).choices(alphabet, k=n))


def found(text):
    return [text[s:e] for s, kind, e in secret_scan.scan(text) if secret_scan.KINDS[kind] == "novel"]


@pytest.mark.parametrize("seed", range(20))
def test_a_key_written_twice_is_found_twice(seed):
    k = key(seed) + "7a"
    assert found(f"credentials {k}\nsome other line\ncredentials {k}\n") == [k, k]
    assert secret_scan.mask(f"bearer {k}\nbearer {k}") == "bearer [novel]\nbearer [novel]"
    # Under two names that belong to the runs.
    assert found(f"auth ONE_ID={k}\nauth OTHER={k}\n") == [f"ONE_ID={k}", f"OTHER={k}"]
    # A copy that the surroundings cut.
    assert found(f"bearer {k} {'x ' * 240}\nbearer {k}") == [k, k]


@pytest.mark.parametrize("alphabet", [BASE64, "0123456789ABCDEF", string.ascii_uppercase + "234567"])
@pytest.mark.parametrize("n", [16, 40, 128, 256, 1000, 5000, 20_000])
def test_keys_of_any_length_are_new(n, alphabet):
    k = "A1" + key(n, n - 2, alphabet)
    assert found(f"credentials {k}") == [k]


def test_runs_that_repeat_themselves_are_not_new():
    for run in ("=" * 40, "=-" * 20, "ab12" * 10, "0" * 30 + "x", "getElementByIdToString0123456789"):
        assert found(f"credentials {run}") == []


def test_every_line_of_a_private_key_is_found():
    lines = [key(i, 64) for i in range(60)]
    text = "\n".join(["some words", "-----BEGIN PRIVATE KEY-----", *lines, "-----END PRIVATE KEY-----"])
    assert found(text) == lines
    assert secret_scan.mask(text).count("[novel]") == 60


def test_labels_on_other_lines_and_behind():
    k = key(1)
    assert found(f'{{"credential":\n  "{k}"}}') == [k]
    assert found(f"credential: >-\n    {k}\n") == [k]
    assert found(f"{k} is the passphrase") == [k]
    assert found(f"{k}{' word' * 60}\nthe passphrase is above") == [k]
    assert found(f"CLIENT_CREDENTIAL={k}") == [f"CLIENT_CREDENTIAL={k}"]
    assert found(f"{k}{' word' * 110} passphrase") == found(f"passphrase {' word' * 110}{k}") == []


@pytest.mark.parametrize("n", [40, 300, 2000])
def test_every_part_of_a_bearer_token_is_found(n):
    parts = [key(1, 36), key(2, n), key(3, 43)]
    assert found(f"Bearer {'.'.join(parts)}") == parts


@pytest.mark.parametrize("alphabet", [string.ascii_lowercase, string.ascii_letters])
@pytest.mark.parametrize("n", [24, 64, 300, 3000])
def test_letters_alone_are_keys_too(n, alphabet):
    k = key(n, n, alphabet)
    assert found(f"credentials {k}") == [k]


def test_digits_alone_are_keys_too():
    for n in range(16, 24):  # longer ones are hexadecimal strings
        k = key(n, n, string.digits)
        assert found(f"credentials {k}") == [k]


def test_authors_are_not_sensitive():
    draw = random.Random(5)
    words = "user config value default response handler session builder report total count index file path load store parse".split()
    for _ in range(300):
        name = draw.choice(["_", "-", "/"]).join(draw.choices(words, k=4))
        for before in ("# author: jane", "The authority on", "a salty secretary and", "basalt, authored by"):
            assert found(f"{before} def {name}(self)") == []
    k = key(3)
    for before in ("authorization", "Authorise", "oauth", "AUTH_ID", "mySecret", "salt", "client-secret"):
        assert found(f"{before} {k}") == [k]


def test_masking_without_counted_characters(spark):
    docs = spark.createDataFrame([(1, "secret: abcdefgh"), (2, None)], "doc_id long, text string")
    assert [r["text"] for r in secret_scan.mask_secrets(docs).orderBy("doc_id").collect()] == ["[assign]", None]
