"""Training-data operators: quality rules, tokenising, exact / line / near /
substring de-duplication, mixing, language-model scoring and URL filtering.

Nothing outside this subpackage imports it.
"""
