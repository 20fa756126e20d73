"""Registered queries over subword vocabularies and vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from folianta import fixed_values as fixed
from folianta.functions import vectors as vec
from folianta.operators import positions, projection, subword
from folianta.operators import token_vectors as token_vectors_of
from folianta.plans import checks as ck
from folianta.plans import derived as dv
from folianta.storage import bounded_table, materialize, shared_dir

DIGITS = 6
TARGET = "the"
VOCABULARY = 500  # tokens of the vocabulary that is listed
SUBWORDS = 2_000
WORDPIECES = PIECES = 1_000
WIDTH, HIDDEN = 64, 16
RANK = 4


def _embeddings(spark, sf_dir):
    return dv.table(spark, sf_dir, "embeddings").select(
        "vec_id", vec.as_doubles(F.col("embedding")).alias("v"), "label"
    )


def _counts(spark, sf_dir):
    return subword.word_counts(dv.documents(spark, sf_dir))


def _shown(vector, digits=4):
    return vec.format_vector(vector, digits)


def token_totals(spark, sf_dir):
    docs = dv.documents(spark, sf_dir)
    per_doc = positions.token_totals(docs)
    # corpus totals come from the word counts, whose rows are already distinct
    corpus = subword.word_counts(docs).agg(
        F.sum("n").alias("n_tokens"), F.count("*").alias("n_distinct")
    )
    return per_doc.unionByName(corpus.select(F.lit(-1).cast("bigint").alias("doc_id"), "*"))


def vocab_by_id(spark, sf_dir):
    return subword.frequency_vocabulary(_counts(spark, sf_dir), VOCABULARY).orderBy("id")


_stored: dict[tuple, str] = {}  # folders of models trained in this session


def _trained(train, size=SUBWORDS, **options):
    """Trains on first use and stores the model; later uses in the session load it."""

    def learn(spark, sf_dir):
        key = (spark.sparkContext.applicationId, sf_dir, train.__name__)
        if key not in _stored:
            path = shared_dir(spark, train.__name__)
            train(_counts(spark, sf_dir), size, **options).save(spark, path)
            _stored[key] = path
        return subword.SubwordModel.load(spark, _stored[key])

    return learn


_bpe = _trained(subword.train_bpe)
_wordpiece = _trained(subword.train_wordpiece, WORDPIECES)
_unigram = _trained(subword.train_unigram, PIECES)


def _vocabulary(learn):
    return lambda spark, sf_dir: learn(spark, sf_dir).vocabulary(spark)


def _encoded(learn):
    def query(spark, sf_dir):
        model = learn(spark, sf_dir)
        coded = dv.documents(spark, sf_dir).select(
            "doc_id", model.encode(spark, F.col("text")).alias("coded")
        )
        return coded.select(
            "doc_id",
            F.size("coded.ids").cast("bigint").alias("n_pieces"),
            F.array_join("coded.tokens", " ").alias("pieces"),
            F.array_join(F.transform("coded.ids", lambda i: i.cast("string")), " ").alias("ids"),
        )

    return query


def _joined(learn, mark=""):
    """Pieces put together again; without an unknown piece they are the pre-tokens."""

    def query(spark, sf_dir):
        model = learn(spark, sf_dir)
        model.longest_word = None
        coded = dv.documents(spark, sf_dir).select("doc_id", model.encode(spark, F.col("text")).alias("c"))
        # a word may itself begin like the mark, so its characters are left out on both sides
        text = F.array_join("c.tokens", "")
        for char in set(mark):
            text = F.replace(text, F.lit(char), F.lit(""))
        known = F.transform("c.ids", lambda i: F.element_at(F.lit(model.tokens), i + 1))
        return coded.select(
            "doc_id",
            text.alias("text"),
            (known == F.col("c.tokens")).alias("ids_name_tokens"),
        )

    return query


def vocabulary_facts(spark, sf_dir):
    """Size of each vocabulary, whether tokens differ, and how many characters it covers."""
    chars = _counts(spark, sf_dir).select(F.explode(F.split("word", "")).alias("token")).distinct()
    chars = materialize(chars, "characters")  # one pass over the texts for all kinds
    kinds = [("bpe", _bpe), ("unigram", _unigram), ("wordpiece", _wordpiece)]
    names = ["n_tokens", "n_distinct", "n_chars"]
    found = None
    for kind, learn in kinds:
        tokens = learn(spark, sf_dir).vocabulary(spark)
        covered = chars.join(tokens, "token", "left_semi").agg(F.count("*").alias("n_chars"))
        none = F.lit(0).cast("bigint")
        sizes = tokens.agg(F.count("*").alias("n_tokens"), F.count_distinct("token").alias("n_distinct"))
        for part in (sizes.select("*", none.alias("n_chars")), covered.select(none, none, "n_chars").toDF(*names)):
            row = part.select(F.lit(kind).alias("kind"), *names)
            found = row if found is None else found.unionAll(row)
    return found.groupBy("kind").agg(*[F.sum(name).alias(name) for name in names])


def first_merges(spark, sf_dir):
    """The first pair merged: the most frequent pair of characters, ties by character."""
    left, right = _bpe(spark, sf_dir).merges[0]
    pairs = subword.pair_counts(_counts(spark, sf_dir))
    return pairs.filter((F.col("left") == left) & (F.col("right") == right)).select("left", "right", "n")


def positional_encoding(spark, sf_dir):
    """An encoding for the place of every vector in its table."""
    encoded = vec.positional_encoding(F.col("vec_id"), WIDTH)
    odd = vec.positional_encoding(F.col("vec_id"), 7)
    rows = dv.table(spark, sf_dir, "embeddings")
    return rows.select("vec_id", _shown(encoded).alias("encoding"), _shown(odd).alias("odd_width"))


def _token_vectors(spark, sf_dir):
    vectors = _embeddings(spark, sf_dir)
    vocabulary = subword.ranked_words(_counts(spark, sf_dir))
    return vectors.join(vocabulary, F.col("vec_id") == F.col("id"))


def token_vectors(spark, sf_dir):
    return _token_vectors(spark, sf_dir).select(
        "token", "id", vec.format_vector(F.col("v")).alias("vector")
    )


def _prefix_model(counts):
    """The most frequent words as pieces, and every character as a piece inside a word."""
    words = [r["token"] for r in subword.frequency_vocabulary(counts, VOCABULARY).orderBy("id").collect()]
    chars = counts.select(F.explode(F.split("word", "")).alias("c")).distinct().orderBy("c").collect()
    mark = fixed.CONTINUATION_PREFIX
    pieces = [subword.UNKNOWN, *words, *[mark + r["c"] for r in chars]]
    return subword.SubwordModel("wordpiece", pieces, prefix=mark, longest_word=None)


def first_piece_vectors(spark, sf_dir):
    # a piece has many words, so its vector is shown before they meet
    vectors = _embeddings(spark, sf_dir).select(F.col("vec_id").alias("id"), vec.format_vector(F.col("v")).alias("vector"))
    counts = materialize(_counts(spark, sf_dir), "words")  # read for the vocabulary, its characters and the words
    # a word that begins like the mark could be taken for a piece inside a word
    words = counts.filter(~F.col("word").startswith(fixed.CONTINUATION_PREFIX))
    found = token_vectors_of.first_piece_vectors(spark, _prefix_model(counts), words, vectors)
    return found.select("word", "n", "piece", F.col("id").cast("bigint").alias("id"), "vector")


def token_occurrences(spark, sf_dir):
    return positions.token_occurrences(dv.documents(spark, sf_dir), TARGET)


def occurrence_pairs(spark, sf_dir):
    return positions.occurrence_pairs(dv.documents(spark, sf_dir), TARGET, every=True)


def _input_embeddings(spark, sf_dir):
    owned = _token_vectors(spark, sf_dir).filter(F.col("token") == TARGET)
    base = bounded_table(owned.select("token", "v"), 1)  # a token owns one vector
    hits = positions.token_occurrences(dv.documents(spark, sf_dir), TARGET)
    return hits.withColumn("token", F.lit(TARGET)).join(base, "token").select(
        "doc_id", "pos", vec.input_embedding(F.col("v"), F.col("pos"), WIDTH).alias("vector")
    )


def input_embedding(spark, sf_dir):
    return _input_embeddings(spark, sf_dir).withColumn("vector", _shown(F.col("vector")))


def _next_pairs(spark, sf_dir):
    left = _embeddings(spark, sf_dir).select("vec_id", F.col("v").alias("a"))
    right = _embeddings(spark, sf_dir).select(
        (F.col("vec_id") - 1).alias("vec_id"), F.col("v").alias("b")
    )
    return left.join(right, "vec_id")


def cosine_pairs(spark, sf_dir):
    similarity = F.round(vec.cosine(F.col("a"), F.col("b")), DIGITS)
    return _next_pairs(spark, sf_dir).select("vec_id", similarity.alias("cosine"))


def vector_add(spark, sf_dir):
    return _next_pairs(spark, sf_dir).select(
        "vec_id", _shown(vec.add(F.col("a"), F.col("b"))).alias("total")
    )


def layer_norm(spark, sf_dir):
    rows = _embeddings(spark, sf_dir)
    gain, shift = [1.0 + 0.5 * (at % 2) for at in range(WIDTH)], [0.25] * WIDTH
    return rows.select(
        "vec_id",
        _shown(vec.layer_norm(F.col("v"))).alias("plain"),
        _shown(vec.layer_norm(F.col("v"), gain, shift, eps=1e-5)).alias("affine"),
    )


def vector_moments(spark, sf_dir):
    return _embeddings(spark, sf_dir).select(
        "vec_id",
        F.round(vec.mean(F.col("v")), DIGITS).alias("mean"),
        F.round(vec.sample_variance(F.col("v")), DIGITS).alias("variance"),
        _shown(F.slice("v", 1, 5)).alias("head"),
    )


def format_vector(spark, sf_dir):
    return _embeddings(spark, sf_dir).select("vec_id", vec.format_vector(F.col("v")).alias("vector"))


def pca_project(spark, sf_dir):
    found = projection.pca_project(_embeddings(spark, sf_dir), "v", RANK)
    return found.select("vec_id", vec.round_vector(F.col("components"), DIGITS).alias("components"))


def pca_apply(spark, sf_dir):
    """Fit on the encodings of the vectors' places, apply to the target's occurrences."""
    base = dv.table(spark, sf_dir, "embeddings").select(
        vec.positional_encoding(F.col("vec_id"), WIDTH).alias("v")
    )
    model = projection.fit_pca(base, "v", RANK)
    hits = positions.token_occurrences(dv.documents(spark, sf_dir), TARGET).withColumn(
        "v", vec.positional_encoding(F.col("pos"), WIDTH)
    )
    found = projection.apply_pca(model, hits, "v")
    return found.select(
        "doc_id", "pos", vec.round_vector(F.col("components"), DIGITS).alias("components")
    )


def layer_weights(width=WIDTH, hidden=HIDDEN):
    """Weights by rule, so that any engine can rebuild them."""
    i, j = np.arange(1, width + 1)[:, None], np.arange(1, hidden + 1)[None, :]
    return np.cos(i + 2.0 * j), np.sin(j[0] * 1.0), np.sin(i + 3.0 * j).T, np.cos(i[:, 0] * 1.0)


def feed_forward(spark, sf_dir):
    w1, b1, w2, b2 = layer_weights()
    rows = _embeddings(spark, sf_dir)
    out = projection.feed_forward(rows, F.col("v"), [(w1, b1), (w2, b2)])
    return rows.select("vec_id", out.alias("o")).select("vec_id", _shown(F.col("o")).alias("output"))


def _svd(method):
    def query(spark, sf_dir):
        rows = _embeddings(spark, sf_dir)
        _, left = projection.truncated_svd(rows, "v", RANK, method, side="left")
        return left.select("vec_id", vec.round_vector(F.col("factors"), DIGITS).alias("factors"))

    return query


def _rebuilt(method):
    """Whether the factors at full rank give every vector back."""

    def query(spark, sf_dir):
        rows = _embeddings(spark, sf_dir)
        values, left = projection.truncated_svd(rows, "v", WIDTH, method, side="left")
        _, right = projection.truncated_svd(rows, "v", WIDTH, method, side="right")
        back = np.array([r["factors"] for r in right.orderBy("component").collect()])  # width-sized
        product = projection.linear(left, F.col("factors"), values[:, None] * back)
        far = F.zip_with("v", "p", lambda x, y: F.abs(x - y))
        return left.withColumn("p", product).select("vec_id", (F.array_max(far) < 1e-6).alias("same"))

    return query


def pca_lengths(spark, sf_dir):
    """Squared lengths of all components, which are those of the centred vectors."""
    found = projection.pca_project(_embeddings(spark, sf_dir), "v", WIDTH)
    return found.select("vec_id", F.round(vec.dot(F.col("components"), F.col("components")), 5).alias("squares"))


def pca_distances(spark, sf_dir):
    """Squared distances of neighbouring vectors, which a rotation keeps."""
    rows = _embeddings(spark, sf_dir)
    found = projection.apply_pca(projection.fit_pca(rows, "v", WIDTH), rows, "v")
    after = found.select((F.col("vec_id") - 1).alias("vec_id"), F.col("components").alias("b"))
    gap = F.zip_with("components", "b", lambda x, y: x - y)
    return found.join(after, "vec_id").select("vec_id", F.round(vec.dot(gap, gap), 5).alias("squares"))


QUERIES = {
    "word_counts": _counts,
    "pair_counts": lambda spark, sf_dir: subword.pair_counts(_counts(spark, sf_dir)),
    "token_totals": token_totals,
    "vocab_by_id": vocab_by_id,
    "bpe_vocab": _vocabulary(_bpe),
    "bpe_encode": _encoded(_bpe),
    "wordpiece_vocab": _vocabulary(_wordpiece),
    "wordpiece_encode": _encoded(_wordpiece),
    "unigram_vocab": _vocabulary(_unigram),
    "unigram_encode": _encoded(_unigram),
    "bpe_joined": _joined(_bpe),
    "wordpiece_joined": _joined(_wordpiece, fixed.CONTINUATION_PREFIX),
    "unigram_joined": _joined(_unigram),
    "vocabulary_facts": vocabulary_facts,
    "first_merges": first_merges,
    "svd_rebuilt": _rebuilt("exact"),
    "randomized_svd_rebuilt": _rebuilt("randomized"),
    "pca_lengths": pca_lengths,
    "pca_distances": pca_distances,
    "token_vectors": token_vectors,
    "first_piece_vectors": first_piece_vectors,
    "token_occurrences": token_occurrences,
    "occurrence_pairs": occurrence_pairs,
    "positional_encoding": positional_encoding,
    "input_embedding": input_embedding,
    "cosine_pairs": cosine_pairs,
    "vector_add": vector_add,
    "layer_norm": layer_norm,
    "vector_moments": vector_moments,
    "format_vector": format_vector,
    "pca_project": pca_project,
    "pca_apply": pca_apply,
    "feed_forward": feed_forward,
    "truncated_svd": _svd("exact"),
    "randomized_svd": _svd("randomized"),
}


def _text(vector: str, digits: int = 4) -> str:
    return (
        f"concat('[', array_to_string(list_transform({vector},"
        f" lambda x: printf('%.{digits}f', x)), ', '), ']')"
    )


def _encoding(position: str, width: int) -> str:
    angle = f"{position} * exp((i - i % 2) * (-ln(10000.0)) / {width})"
    return (
        f"list_transform(range({width}), lambda i:"
        f" CASE WHEN i % 2 = 0 THEN sin({angle}) ELSE cos({angle}) END)"
    )


_TOKENS = f"SELECT doc_id, unnest({ck.tokens('text')}) AS word FROM documents"
_WORDS = f"SELECT word, count(*) AS n FROM ({_TOKENS}) GROUP BY word"
_RANKED = f"SELECT word AS token, row_number() OVER (ORDER BY n DESC, word) - 1 AS id, n FROM ({_WORDS})"
_VOCAB = f"{_RANKED} ORDER BY n DESC, word LIMIT {VOCABULARY}"
_HITS = f"""SELECT doc_id, pos FROM (SELECT doc_id, unnest({ck.tokens('text')}) AS word,
            unnest(range(len({ck.tokens('text')}))) AS pos FROM documents) WHERE word = '{TARGET}'"""
_V = "SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings"
_PAIRS = f"SELECT a.vec_id, a.v AS a, b.v AS b FROM ({_V}) a JOIN ({_V}) b ON b.vec_id = a.vec_id + 1"
_MEAN = "(list_sum(v) / len(v))"
_SQUARES = f"list_sum(list_transform(v, lambda x: (x - {_MEAN}) * (x - {_MEAN})))"
_NORM = "list_transform(v, lambda x: (x - m) / sqrt(s / len(v) + {eps}))"

ORACLES = {
    "word_counts": _WORDS,
    "pair_counts": f"""
        SELECT word[i] AS "left", word[i + 1] AS "right", sum(n)::BIGINT AS n
        FROM (SELECT word, n, unnest(range(1, length(word))) AS i FROM ({_WORDS})) GROUP BY 1, 2""",
    "token_totals": f"""
        SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct
        FROM (SELECT doc_id, {ck.tokens('text')} AS t FROM documents)
        UNION ALL SELECT -1, sum(n)::BIGINT, count(*) FROM ({_WORDS})""",
    "vocab_by_id": _VOCAB,
    **dict.fromkeys(
        ("bpe_joined", "unigram_joined"),
        f"SELECT doc_id, array_to_string({ck.tokens('text')}, '') AS text, true AS ids_name_tokens FROM documents",
    ),
    "wordpiece_joined": f"""
        SELECT doc_id, replace(array_to_string({ck.tokens('text')}, ''), '#', '') AS text, true AS ids_name_tokens
        FROM documents""",
    "vocabulary_facts": f"""
        WITH c AS (SELECT count(DISTINCT c) AS n FROM (SELECT unnest(string_split(word, '')) AS c FROM ({_WORDS})))
        SELECT kind, size AS n_tokens, size AS n_distinct, n AS n_chars
        FROM (VALUES ('bpe', {SUBWORDS}::BIGINT), ('unigram', {PIECES}), ('wordpiece', {WORDPIECES})) AS k(kind, size), c""",
    "first_merges": f"""
        SELECT word[i] AS "left", word[i + 1] AS "right", sum(n)::BIGINT AS n
        FROM (SELECT word, n, unnest(range(1, length(word))) AS i FROM ({_WORDS}))
        GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 1""",
    **dict.fromkeys(("svd_rebuilt", "randomized_svd_rebuilt"), "SELECT vec_id, true AS same FROM embeddings"),
    "pca_lengths": f"""
        WITH m AS (SELECT i, avg(x) AS mean FROM (SELECT unnest(v) AS x, unnest(range(len(v))) AS i FROM ({_V})) GROUP BY i)
        SELECT vec_id, round(sum((x - mean) * (x - mean)), 5) AS squares
        FROM (SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS i FROM ({_V})) JOIN m USING (i) GROUP BY vec_id""",
    "pca_distances": f"""
        SELECT vec_id, round(list_sum(list_transform(list_zip(a, b), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 5) AS squares
        FROM ({_PAIRS})""",
    "first_piece_vectors": f"""
        WITH w AS ({_WORDS}), v AS ({_VOCAB}),
        firsts AS (SELECT w.word, w.n, arg_max(v.token, length(v.token)) AS piece
                   FROM w JOIN v ON starts_with(w.word, v.token) WHERE NOT starts_with(w.word, '##') GROUP BY w.word, w.n)
        SELECT word, firsts.n, piece, v.id + 1 AS id, {_text('e.v', 2)} AS vector
        FROM firsts JOIN v ON v.token = piece JOIN ({_V}) e ON e.vec_id = v.id + 1""",
    "token_vectors": f"SELECT token, id, {_text('v', 2)} AS vector FROM ({_RANKED}) JOIN ({_V}) ON vec_id = id",
    "token_occurrences": _HITS,
    "occurrence_pairs": f"""
        WITH h AS (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY doc_id) AS n FROM ({_HITS}) WHERE doc_id IS NOT NULL),
        d AS (SELECT doc_id, list_filter(range(len(t)), lambda i: t[i + 1] = '{TARGET}') AS p
              FROM (SELECT doc_id, {ck.tokens('text')} AS t FROM documents))
        SELECT 'same_position' AS kind, a.doc_id AS doc_a, a.pos AS pos_a, b.doc_id AS doc_b, b.pos AS pos_b
        FROM h a JOIN h b ON a.pos = b.pos AND a.n < b.n
        UNION ALL
        SELECT 'same_document', doc_id, p[i], doc_id, unnest(p[i + 1:])
        FROM (SELECT doc_id, p, unnest(range(1, len(p))) AS i FROM d)""",
    "positional_encoding": f"""
        SELECT vec_id, {_text(_encoding('vec_id', WIDTH))} AS encoding,
               {_text(_encoding('vec_id', 7))} AS odd_width FROM embeddings""",
    "input_embedding": f"""
        WITH h AS ({_HITS}),
        base AS (SELECT v FROM ({_RANKED}) JOIN ({_V}) ON vec_id = id WHERE token = '{TARGET}')
        SELECT doc_id, pos, {_text(f"list_transform(list_zip(v, {_encoding('pos', WIDTH)}), lambda z: z[1] * sqrt({WIDTH}) + z[2])")} AS vector
        FROM h, base""",
    "cosine_pairs": f"SELECT vec_id, round(list_cosine_similarity(a, b), {DIGITS}) AS cosine FROM ({_PAIRS})",
    "vector_add": f"SELECT vec_id, {_text('list_transform(list_zip(a, b), lambda z: z[1] + z[2])')} AS total FROM ({_PAIRS})",
    "layer_norm": f"""
        SELECT vec_id, {_text(_NORM.format(eps='1e-12'))} AS plain,
               {_text("list_transform(" + _NORM.format(eps='1e-5') + ", lambda y, i: y * (1.0 + 0.5 * ((i - 1) % 2)) + 0.25)")} AS affine
        FROM (SELECT vec_id, v, {_MEAN} AS m, {_SQUARES} AS s FROM ({_V}))""",
    "vector_moments": f"""
        SELECT vec_id, round({_MEAN}, {DIGITS}) AS mean, round({_SQUARES} / (len(v) - 1), {DIGITS}) AS variance,
               {_text('v[1:5]')} AS head FROM ({_V})""",
    "format_vector": f"SELECT vec_id, {_text('v', 2)} AS vector FROM ({_V})",
    "feed_forward": f"""
        WITH h AS (SELECT vec_id, list_transform(range(1, {HIDDEN + 1}), lambda j:
                 list_sum(list_transform(v, lambda x, i: x * cos(i + 2.0 * j))) + sin(j)) AS h FROM ({_V}))
        SELECT vec_id, {_text(f"list_transform(range(1, {WIDTH + 1}), lambda i: list_sum(list_transform(h, lambda x, j: x * sin(i + 3.0 * j))) + cos(i))")} AS output
        FROM h""",
}
