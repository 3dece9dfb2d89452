"""Operations for preparing language-model training data.

Thirteen operators (one module each) and the queries that apply them to the
``documents``, ``embeddings`` and ``benchmark`` tables.  Nothing else in the library imports
this subpackage; it imports only general helpers of the library.
"""
