"""Operations for preparing training text at scale.

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface, and the thin query that applies it to the
registered tables. Unless a function says otherwise, operators take the columns
they need by name and return new rows, so extra columns of any name never clash.
"""
