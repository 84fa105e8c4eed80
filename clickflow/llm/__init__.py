"""Training-data operators: exact search, mixing, toxicity, tokenizers, chat formatting,
quality rules, near duplicates, licences and line dedup.

Nothing else in the library imports this subpackage. Each module holds one operator with
its own interface; ``queries`` registers the thin query functions and their oracle SQL.
"""
