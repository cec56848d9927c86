"""Training-data operators (token counts to language ID) for large text corpora.

Nothing else in the library imports this package; general helpers (session,
checkpoint folder) are imported from outside. ``queries`` registers one query
per operator, ``oracles`` the SQL twins.
"""
