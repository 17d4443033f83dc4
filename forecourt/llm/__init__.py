"""Training-data operators: de-duplication, language and quality models, search, packing.

Nothing outside this package imports it. Each module holds one operator; ``queries`` registers
one ``opN_<name>`` query per operator plus ``pipeline``.
"""
