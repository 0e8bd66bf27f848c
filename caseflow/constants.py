"""Fixed values of the study: court codes, movement codes, word lists."""

# Codes of the specialised bankruptcy courts.
SPECIALISED_COURTS = (26404, 26422, 13951, 13952, 13950, 13752, 8816, 8809)

# Movement codes of the national movement table.
ADMITTED = 430
NOT_ADMITTED = 433
RECEIVED = 132
LACK_OF_JURISDICTION = 941
FINAL_ARCHIVE = 246
FINAL_JUDGMENT = 848
CONCLUSION = 51
ROOT_JUDGE = 1
ROOT_CLERK = 14

# Labels written to the result tables.
GROUP_SPECIALISED = "especializada"
GROUP_OTHER = "nao_especializada"
GROUPED_COURTS = "nao_especializada (agrupadas)"
EMPTY_CODE = "{}"

# Party roles that may close a party sentence.
PARTY_ROLES = (
    "Promovente", "Promovido", "Terceiro", "Réu", "Reus", "Autor", "Executado", "Exequente",
)
