"""Operations for preparing language-model training data at corpus scale.

Nothing else in the library imports this subpackage.  ``queries`` holds the thin
``opN_<name>`` queries, the other modules the operators with their own interfaces.
"""
