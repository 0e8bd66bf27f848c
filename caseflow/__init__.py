"""caseflow: life-cycle analytics of court cases as ordinary Spark jobs.

Every public function takes DataFrames and returns DataFrames.  Table columns
keep the Portuguese names of the court data model (``processo``,
``movimento_codigo``, ``data_ajuizamento`` ...).
"""
