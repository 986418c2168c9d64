"""Small tables of the llm tests (a module of its own: every test folder has a conftest)."""

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that clash with names the operators use inside.
CLASH = ["row", "size", "fp", "th", "k", "key", "kid", "u", "v", "h", "tie", "range", "target", "component",
         "component_id", "fingerprint", "score", "lang_pred", "token_ids", "first", "sha1", "payload", "node", "own",
         "segments", "n", "rid", "cell", "pos", "ambiguous", "d", "nodes", "shard", "x", "cnt", "word", "start",
         "run", "gram", "kept", "n_words", "rows", "hash", "turns"]


def clashing(df):
    """``df`` with an extra column of every clashing name it lacks."""
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("x").alias(c) for c in CLASH if c not in df.columns])
