"""Training-data operators: near-duplicates, quality, tokens, language models, web records, chat.

One module per operator.  Each module holds the operator (its own general
interface), the parameters used in production, and the thin registered
query (``opN_<name>``); ``registry`` lists the queries and their SQL twins.
"""
