"""Whole jobs: the body and title annotation pipelines and the user-facing
batch jobs (T13, T14, G1-G6).

A pipeline is plain function composition over lazy DataFrames, so Catalyst
sees one plan: columns nobody reads are never computed, and every per-document
step runs inside the one hash partitioning made by ``by_document``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.operators import context_tags, entities, keywords as kw, reshape, segment, select, sequence, vectors
from docweave.session import checkpoint_dir, stored
from docweave.sources import epochs, files


@dataclass
class BodyParams:
    min_n: int = 1
    max_n: int = 3
    k: int = 10
    threshold: float = 0.6
    context_chars: str = segment.CONTEXT_CHARS
    rules: tuple = entities.RULES
    extra_entities: object = None  # optional callable(docs, id, text, sentences) -> spans
    pos_model: object = None       # context_tags.ContextModel: part of speech of every token
    vocabulary: object = None      # (token, vector) table: vectors of tokens and sentences
    dim: int = 64
    tagger: object = None          # sequence.ChainModel: entities by the model instead of the rules


def _fold(df: DataFrame, id_col: str, order: list, value: str, out: str) -> DataFrame:
    return _fold_all(id_col, {out: (df, order, value)})


def _fold_all(id_col: str, parts: dict[str, tuple[DataFrame, list, str]]) -> DataFrame:
    """One row per id with an array column for each part (rows, order, value): the rows
    of all parts meet in one group-by, which re-uses their common partitioning."""
    rows = None
    for kind, (df, order, value) in enumerate(parts.values()):
        keys = [o.cast("double") if i == 0 else o.cast("string") for i, o in enumerate(order)]
        keys += [F.lit(None).cast("string")] * (2 - len(keys))
        part = df.select(id_col, F.lit(kind).alias("__kind"),
                         F.struct(keys[0].alias("o0"), keys[1].alias("o1"), F.col(value).alias("v")).alias("__s"))
        rows = part if rows is None else rows.unionByName(part)
    folds = [F.transform(F.sort_array(F.collect_list(F.when(F.col("__kind") == kind, F.col("__s")))),
                         lambda s: s["v"]).alias(name) for kind, name in enumerate(parts)]
    return rows.groupBy(id_col).agg(*folds)


def featured_tokens(tokens: DataFrame, id_col: str, p: BodyParams, partitions: int | None = None,
                    keep: bool = False) -> DataFrame:
    """Tokens with ``pos_tag`` and ``embedding``, as far as the models are given.  With
    ``keep``, the tagged tokens are stored: several branches read them, and each would tag
    them again."""
    if p.pos_model is not None:
        tokens = context_tags.tag_in_context(tokens, p.pos_model, id_col, out_col="pos_tag")
        if keep:
            tokens = segment.by_document(stored(tokens), id_col, partitions)
    if p.vocabulary is not None:
        tokens = vectors.embed_tokens(tokens, p.vocabulary, p.dim, id_col=id_col)
    return tokens


def annotate_body(docs: DataFrame, id_col: str, text_col: str, p: BodyParams | None = None,
                  partitions: int | None = None, keep: bool = False) -> dict:
    """Long-form annotation tables of a document-partitioned frame:
    sentences, tokens, entity spans (with sentence) and keywords; with their models also
    ``features`` (tokens with part of speech and vector) and ``vectors`` (of
    sentences), and entities by the chain tagger on those features.  ``keep`` stores the
    tagged tokens, for callers that read the features more than once."""
    p = p or BodyParams()
    sentences = segment.split_sentences(docs, id_col, text_col)
    tokens = segment.tokenize_sentences(sentences, id_col, p.context_chars)
    out = {"sentences": sentences, "tokens": tokens}
    if p.pos_model is not None or p.vocabulary is not None or p.tagger is not None:
        out["features"] = featured_tokens(segment.tokenize_sentences(sentences, id_col), id_col, p, partitions, keep)
    if p.vocabulary is not None:
        out["vectors"] = vectors.sentence_vectors(out["features"], id_col, p.dim)
    if p.tagger is not None:
        tagged = sequence.tag_chain(out["features"], p.tagger, id_col)
        spans = entities.entity_chunks(tagged, docs, id_col, text_col).withColumn("priority", F.lit(0))
    else:
        spans = entities.rule_spans(docs, id_col, text_col, p.rules)
        spans = entities.assign_sentences(spans, sentences, id_col)
    if p.extra_entities is not None:
        spans = spans.unionByName(p.extra_entities(docs, id_col, text_col, sentences))
    keys = kw.keywords(tokens, id_col, p.min_n, p.max_n, p.k, p.threshold)
    return out | {"entities": spans, "keywords": keys}


def enrich_body(docs: DataFrame, id_col: str, text_col: str, p: BodyParams | None = None,
                partitions: int | None = None, keep_layout: bool = False) -> DataFrame:
    """Add ``sentences``, ``entities`` and ``keywords`` (array<string>) to each
    document row, and ``pos`` (the tokens' parts of speech) with a ``pos_model``.
    Documents with no entity / keyword get an empty array.

    The text is hash-partitioned once as (id, text): every annotation branch
    and the output read that one exchange (identical plans are reused).  The
    other columns travel in a separate, narrow shuffle without the text, and
    all re-joins are co-partitioned on the id, so none of them shuffles again.
    """
    if partitions is None and not keep_layout:
        partitions = segment.document_partitions(docs)
    text = segment.by_document(docs.select(id_col, text_col), id_col, partitions, keep_layout)
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    # with both, the features are read for the parts of speech and for the entities
    keep = p is not None and p.pos_model is not None and p.tagger is not None
    a = annotate_body(text, id_col, text_col, p, partitions, keep)
    parts = {"sentences": (a["sentences"], [F.col("begin")], "result"),
             "entities": (a["entities"], [F.col("begin")], "result"),
             "keywords": (a["keywords"], [kw.rank_key("score"), F.col("keyword")], "keyword")}
    if p is not None and p.pos_model is not None:
        parts["pos"] = (a["features"], [F.col("begin")], "pos_tag")
    folds = _fold_all(id_col, parts).withColumnRenamed(id_col, "__k")
    out = text
    if others:
        meta = segment.by_document(docs.select(id_col, *others), id_col, partitions, keep_layout)
        out = out.join(meta.withColumnRenamed(id_col, "__k"), F.col(id_col) == F.col("__k"), "left").drop("__k")
    out = out.join(folds, F.col(id_col) == F.col("__k"), "left").drop("__k")
    empty = F.array().cast("array<string>")
    return out.select(*docs.columns, *[F.coalesce(c, empty).alias(c) for c in parts])


def index_row(enriched: DataFrame, work: tuple[str, ...] = ("body_text", "source_id", "index_date")) -> DataFrame:
    """Enriched rows as the index takes them: work columns dropped, and nothing but
    scalars and array<string> left."""
    out = enriched.drop(*work)
    for f in out.schema.fields:
        if not files.index_ready(f.dataType):
            raise ValueError(f"column {f.name} ({f.dataType.simpleString()}) is not index-ready")
    return out


def enrich_title(docs: DataFrame, id_col: str, title_col: str, k: int = 3,
                 threshold: float = 0.6) -> DataFrame:
    """Title pipeline: no sentence step, document-scoped tokens, ``k`` keywords."""
    toks = segment.tokenize(docs, id_col, title_col, scope="document",
                            context_chars=segment.CONTEXT_CHARS)
    keys = kw.keywords(toks, id_col, 1, 3, k, threshold)
    folded = _fold(keys, id_col, [kw.rank_key("score"), F.col("keyword")], "keyword", "title_keywords")
    folded = folded.withColumnRenamed(id_col, "__k")
    out = docs.join(folded, F.col(id_col) == F.col("__k"), "left").drop("__k")
    return out.withColumn("title_keywords", F.coalesce("title_keywords", F.array().cast("array<string>")))


def title_keywords(content: DataFrame, k: int = 3, id_col: str = "id", title_col: str = "title",
                   keep_layout: bool = False) -> DataFrame:
    """(id, title, title_keywords) for every content row."""
    docs = segment.by_document(content.select(id_col, title_col), id_col, keep_layout=keep_layout)
    return enrich_title(docs, id_col, title_col, k)


def enrich_batch(content: DataFrame, source: DataFrame, min_size: int | None = 1000,
                 max_size: int | None = 100000, batch: int | None = 30, partitions: int | None = None,
                 params: BodyParams | None = None, keep_layout: bool = False) -> DataFrame:
    """G1: lookup join, size window, newest batch, body pipeline, index rows.

    Output: the content columns + ``source`` + ``sentences``/``entities``/
    ``keywords`` as array<string>; no annotation structs remain.
    """
    df = select.with_source(content, source)
    df = select.filter_size(df, "structure_size", min_size, max_size)
    df = select.newest_rows(df, "last_updated", batch, "id")
    if partitions is None and batch is not None:  # a batch is as large wherever it is taken from
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return enrich_body(df, "id", "body_text", params, partitions, keep_layout)


def entity_job(content: DataFrame, min_size: int | None = 1000, max_size: int | None = 10000,
               types=None, partitions: int | None = None, keep_layout: bool = False,
               params: BodyParams | None = None) -> dict:
    """Entity table, per-type pivot and the pivot re-joined to the rows.  Entities come
    from the rules, or with a ``tagger`` in ``params`` from the model.

    Returns lazy frames ``table``, ``pivot``, ``rows``; ``save_both`` writes
    two of them from one persisted annotation.
    """
    df = select.filter_size(content, "structure_size", min_size, max_size)
    df = segment.by_document(df, "id", partitions, keep_layout)
    spans = annotate_body(df, "id", "body_text", params)["entities"]
    table = reshape.entity_table(spans, "id")
    types = sorted(types or [n for n, _ in entities.RULES])
    pivot = reshape.pivot_entities(table, types)
    rows = reshape.attach_entities(df.select("id", "title", "uri"), pivot)
    return {"table": table, "pivot": pivot, "rows": rows}


def incremental_copy(content: DataFrame, source: DataFrame, ledger: DataFrame,
                     min_size: int | None = 100, max_size: int | None = 1000000,
                     batch: int | None = 100) -> DataFrame:
    """Rows not yet in the ledger, in the size window, newest first."""
    df = select.with_source(content, source)
    df = select.filter_size(df, "structure_size", min_size, max_size)
    df = select.unindexed_by_ledger(df, ledger, "id", "id")
    return select.newest_rows(df, "last_updated", batch, "id")


def keyword_report(texts: DataFrame, id_col: str, text_col: str, min_n: int = 1, k: int = 10,
                   top: int = 5, threshold: float | None = 0.6) -> DataFrame:
    """Context tokens -> keywords -> (keyword, score) pairs -> corpus best."""
    docs = segment.by_document(texts, id_col)
    toks = segment.tokenize(docs, id_col, text_col, scope="sentence", context_chars=segment.CONTEXT_CHARS)
    keys = kw.keywords(toks, id_col, min_n, 3, k, threshold)
    pairs = kw.keyword_pairs(kw.keyword_annotations(keys, id_col), "keywords", id_col)
    return kw.best_keywords(pairs.select(id_col, F.col("result").alias("keyword"), "score"), top)


@dataclass
class Sink:
    """A write target: ``fmt`` + ``options`` for ``DataFrameWriter``."""
    fmt: str
    options: dict = field(default_factory=dict)
    mode: str = "overwrite"
    path: str | None = None

    def write(self, df: DataFrame) -> None:
        w = df.write.format(self.fmt).options(**self.options).mode(self.mode)
        w.save(self.path) if self.path else w.save()


def save_both(annotated: DataFrame, index_rows, table_rows, index_sink: Sink, table_sink: Sink,
              reliable: bool = True) -> None:
    """Write two views of one annotation run; the annotation runs once.

    ``reliable`` checkpoints the shared frame into ``spark.checkpoint.dir``
    (shared storage on a cluster): lineage is cut, so losing an executor
    during the second write re-reads the checkpoint instead of re-running the
    pipeline.  Otherwise it is persisted (memory, spilling to disk)."""
    checkpoint_dir(annotated.sparkSession)
    shared = annotated.checkpoint(eager=True) if reliable else annotated.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        index_sink.write(index_rows(shared))
        table_sink.write(table_rows(shared))
    finally:
        if not reliable:
            shared.unpersist()


def publish_both(annotated: DataFrame, index_rows, table_rows, base: str) -> str:
    """G6 as one epoch below ``base`` (see ``sources.epochs``): readers of the index rows
    and of the entity table see the same run, or the one before."""
    spark = annotated.sparkSession
    checkpoint_dir(spark)
    shared = annotated.checkpoint(eager=True)
    return epochs.publish(spark, base, {"index": index_rows(shared), "table": table_rows(shared)})


def explain_documents(docs: DataFrame, id_col: str, text_col: str, tag_model) -> DataFrame:
    """T14 preset: sentence-scoped tokens, their normal form and POS tag, folded
    to one row per document (tokens / normalized / pos as space-joined text)."""
    from docweave.operators import tags
    toks = segment.tokenize(docs, id_col, text_col, scope="sentence")
    toks = tags.tag_tokens(toks, tag_model, id_col=id_col)
    toks = toks.withColumn("norm", F.lower(F.regexp_replace("result", r"[^\p{L}]", "")))
    order = F.struct("sentence", "pos")
    parts = F.sort_array(F.collect_list(F.struct(order.alias("o"), "result", "norm", "tag")))
    g = toks.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_tokens"), parts.alias("__p"))
    # counted in the array: a distinct aggregate would keep the lists once more
    sentences = F.size(F.array_distinct(F.transform("__p", lambda s: s["o"]["sentence"])))
    return g.select(
        id_col, "n_tokens", sentences.cast("long").alias("n_sentences"),
        F.array_join(F.transform("__p", lambda s: s["result"]), " ").alias("tokens"),
        F.array_join(F.filter(F.transform("__p", lambda s: s["norm"]), lambda x: x != ""), " ").alias("normalized"),
        F.array_join(F.transform("__p", lambda s: s["tag"]), " ").alias("pos"))
