"""Operators for preparing text corpora for model training.

Nothing outside this folder imports it.  Each module holds one operator as
``DataFrame -> DataFrame`` functions; ``queries`` registers one query per
operator over the whole driver tables.

Common rules of all operators:

* a NULL text counts as an empty text unless the docstring says otherwise;
* a row is a document: repeated rows stay repeated, a NULL id stays NULL;
* extra columns of the input are ignored unless the docstring says they are
  carried, so clashing names are harmless;
* an empty table gives an empty result with the same columns;
* intermediate tables go to the shared folder named by
  ``spark.checkpoint.dir`` (see ``functions.sizing.materialize``).
"""
