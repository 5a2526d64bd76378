from collections import Counter

from helpers import PROSE, WORDS, awkward, nothing

from tidemark.llm.quality_lines import LineRules, cleaned_documents, judged


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words by plain counting."""
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_measures_equal_plain_counting(spark):
    texts = [
        "a a a a", "a b c a b c", "a b c x a b c y c a b c", "p q\np q\n \np q", "# $ % & | < >",
        "a b", "\n\n", "a b c\td\x0be", "x y z " * 30, None, "", PROSE, PROSE + "\n" + PROSE,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in judged(docs).collect():
        assert tuple(r[c] for c in COLUMNS) == measures(texts[r.doc_id]), texts[r.doc_id]
        n, _, _, _, repeated = measures(texts[r.doc_id])
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert not (r.base_failed and r.kept)


def test_lines_that_fail_go_and_too_much_loss_rejects(spark):
    menu = "Home\nhome | news | sport | more\nThis line has no end\nAll rights reserved by nobody.\n*** $$$ ### &&&"
    docs = spark.createDataFrame(
        [(1, PROSE + "\n" + menu), (2, "\n".join("this line has many words but no end" for _ in range(12))), (3, PROSE)],
        "doc_id bigint, text string",
    )
    got = {r.doc_id: r for r in judged(docs).collect()}
    assert got[1].kept and got[1].cleaned == PROSE and got[1].n_removed_lines == 5
    assert not got[2].kept and got[2].kept_chars == 0
    assert got[3].kept and got[3].cleaned == PROSE and got[3].n_removed_lines == 0


def test_awkward_rows_and_clashing_columns(spark):
    docs = awkward(spark, clash=("kept", "row", "t", "words"))
    got = judged(docs).collect()
    assert len(got) == docs.count()
    assert not any(r.kept for r in got if not (r.text or "").strip())
    assert all(r.kept for r in got if r.text == PROSE)
    kept = cleaned_documents(docs)
    assert kept.columns == docs.columns
    assert {(r.doc_id, r.kept) for r in kept.collect()} == {(4, "own kept"), (None, "own kept")}
    assert judged(nothing(spark)).count() == 0


def test_length_column_follows_the_text(spark):
    docs = spark.createDataFrame([(1, PROSE + "\nHome", 0)], "doc_id bigint, text string, n_chars bigint")
    row = cleaned_documents(docs, LineRules(min_words=10)).first()
    assert row.text == PROSE and row.n_chars == len(PROSE)
