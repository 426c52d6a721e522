"""Fixture rows shared by the tests of this folder."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, held_out boolean, key string, id long"


def prose(seed: int, words: int, language: str = "en") -> str:
    rng = random.Random(seed)
    common = {"en": "the of and to in is that it for on with as this by river house green walk", "de": "der die und das nicht ist mit auf für schön größe wasser haus gehen"}[language].split()
    return " ".join(rng.choice(common) if rng.random() < 0.5 else "".join(rng.choice("abcdeilmnorst") for _ in range(rng.randint(3, 7))) for _ in range(words))


def row(doc_id, text, lang="en", source="web"):
    return (doc_id, text, lang, source, None if text is None else len(text), 9.0, True, "k", 1)


def cases() -> list[tuple]:
    """Nulls, empties, long texts, copies, near copies, ties and repeated rows."""
    base = prose(1, 60)
    near = base.rsplit(" ", 1)[0] + " other"
    rows = [
        row(1, None), row(2, ""), row(3, " \t\n "), row(4, "Word"), row(5, "one two three"), row(6, base), row(7, base.upper()), row(8, near),
        row(9, base), row(9, base), row(None, "a text without an id at all"), row(10, prose(2, 4000)), row(11, "\n".join([prose(3, 12)] * 4)),
        row(12, 'password = "hunter2secret" and token: abc123def AKIA' + "A1" * 10 + " " + "0f" * 16 + " é " + "ab" * 12, None, None),
        row(13, "naïve café — “quotes” 🙂 ½ x² <|endoftext|> don't   stop\r\n\x1c٣"), row(14, "### *** %%% $$$ &&& ||| <> ### *** %%% $$$ &&&"),
        row(15, "a b c d e f g h i j a b c d e f g h i j k l m n"), row(16, "x" * 5000), row(17, "é" * 300 + " " + "ab" * 200),
    ]
    rows += [row(100 + i, prose(1000 + i, 40 + i % 30, "de" if i % 3 == 0 else "en"), "de" if i % 3 == 0 else "en") for i in range(60)]
    return rows
