"""Operators for preparing language-model training data.

Each module holds one operator: quality classifier (:mod:`.quality_model`),
SimHash near-duplicates (:mod:`.simhash`), WARC archives (:mod:`.warc`), URL
filters (:mod:`.url_filter`), line dedup (:mod:`.line_dedup`), byte-level BPE
(:mod:`.bpe`), quality rules (:mod:`.quality_rules`), substring dedup
(:mod:`.substring_dedup`), personal data (:mod:`.pii`), benchmark
decontamination (:mod:`.decontamination`), vector codes (:mod:`.vector_codes`), token
counts (:mod:`.token_counts`) and the conversation prefix trie (:mod:`.prefix_trie`).  :mod:`.queries` registers one
query each; :mod:`.sql` has their DuckDB SQL where SQL can express them.
Nothing else in the package imports this folder.
"""
