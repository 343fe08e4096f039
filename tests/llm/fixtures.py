"""Small odd tables used by several tests: nulls, empty and long texts, ties, clashing extra columns."""

WORDS = "the quick brown fox jumps over a lazy dog while seven grey owls watch from an old oak tree".split()


def prose(n, seed=1):
    out, x = [], seed
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 16) % 50))
    return " ".join(out)


def odd_documents(spark):
    """Extra columns take names that operators might use themselves."""
    long = prose(9000, 7)
    rows = [
        (1, "Hello World", "a", 1), (2, "hello world", "a", 1), (3, None, None, None), (4, "", "b", 0),
        (5, long, "c", 2), (6, long, "c", 2), (6, long, "c", 2), (None, "hello WORLD", None, 1),
        (7, "ÀB c", "d", 3), (8, "àb c", "d", 3), (9, "  two  spaces\tand tabs \n", "e", 4),
        (10, "<|endoftext|> x", "e", 4), (11, prose(300, 3), "f", 5), (12, prose(300, 3) + " tail", "f", 5),
        (13, "x", "g", 6), (14, "one two three", "g", 6), (15, "日本語 テキスト 🙂", "h", 7),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, source string, shard int"
    ).selectExpr("doc_id", "text", "source", "source as lang", "shard as n_chars", "shard", "doc_id as keep_id",
                 "text as folded", "shard as worker", "doc_id as component_id")


def empty_documents(spark):
    return odd_documents(spark).limit(0)
