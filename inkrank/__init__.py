"""Text search and link ranking on Spark DataFrames."""

from inkrank.operators.graph import (
    adjacency,
    count_pages,
    extract_links,
    initial_graph,
    initial_ranks,
    link_counts,
    numbered_titles,
    out_degree,
    pack_links,
    unpack_links,
    write_links,
)
from inkrank.operators.postings import (
    doc_frequency,
    doc_word_count,
    term_frequency,
    tf_idf,
    tf_idf_of_terms,
    tf_idf_of_weights,
    tf_idf_window,
    tokenize,
)
from inkrank.operators.rank import (
    LinkGraph,
    link_graph,
    number_sorted,
    page_rank,
    rank_step,
    sort_ranks,
    start_ranks,
)
from inkrank.operators.saved_rank import graph_note, rank_saved, write_graph
from inkrank.operators.saved_search import (
    search_bucketed,
    search_sliced,
    write_bucketed_index,
    write_sliced_index,
)
from inkrank.operators.search import (
    in_document_order,
    search,
    search_many,
    search_many_texts,
    search_texts,
    search_tokens,
)
from inkrank.sources.corpus import (
    corpus_size,
    count_files,
    read_corpus,
    read_pages,
    table_corpus,
    table_lines,
)
from inkrank.sources.counts import (
    append_counts,
    append_documents,
    read_counts,
    saved_size,
    saved_tf_idf,
)
from inkrank.sources.index import packed_order, read_index, read_packed, write_index, write_packed
from inkrank.sources.sinks import write_tsv

__all__ = [
    "LinkGraph",
    "adjacency",
    "append_counts",
    "append_documents",
    "corpus_size",
    "count_files",
    "count_pages",
    "doc_frequency",
    "doc_word_count",
    "extract_links",
    "graph_note",
    "in_document_order",
    "initial_graph",
    "initial_ranks",
    "link_counts",
    "link_graph",
    "number_sorted",
    "numbered_titles",
    "out_degree",
    "pack_links",
    "packed_order",
    "page_rank",
    "rank_saved",
    "rank_step",
    "read_corpus",
    "read_counts",
    "read_index",
    "read_packed",
    "read_pages",
    "saved_size",
    "saved_tf_idf",
    "search",
    "search_bucketed",
    "search_many",
    "search_many_texts",
    "search_sliced",
    "search_texts",
    "search_tokens",
    "sort_ranks",
    "start_ranks",
    "table_corpus",
    "table_lines",
    "term_frequency",
    "tf_idf",
    "tf_idf_of_terms",
    "tf_idf_of_weights",
    "tf_idf_window",
    "tokenize",
    "unpack_links",
    "write_bucketed_index",
    "write_graph",
    "write_index",
    "write_links",
    "write_packed",
    "write_sliced_index",
    "write_tsv",
]
