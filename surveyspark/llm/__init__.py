"""Training-data operators: chat formatting, PII, toxicity, near duplicates, tokenisers,
HTML extraction, nearest neighbours, packing and quality rules.

Nothing outside this subpackage imports it. Each operator is a module with a
DataFrame -> DataFrame function of its own; ``queries`` registers one thin
``opN_`` query per operator.
"""
