"""How the given tables play the part of event feeds, and the SQL the results must equal.

Not part of the library: the joins and made-up nulls here only turn other tables into feeds.
"""
