"""Fixed values of the Portuguese question language: word lists and patterns that results depend on."""

# --- Fixed values -----------------------------------------------------------------------------

STOP_WORDS = (
    "a o as os um uma uns umas de da do das dos em no na nos nas e ou que qual "
    "quais quanto quantos quanta quantas como onde quando para pra pro por pelo pela pelos pelas com sem "
    "se eu me mim voce vc isso isto esse essa esses essas este esta estes estas ser sao foi foram era "
    "eram tem teve tiveram ha houve ao aos sobre entre ja ai la favor quero queria gostaria saber "
    "mostre mostra mostrar diga dizer dados"
).split()

PLURAL_ENDINGS = [("oes", "ao"), ("aes", "ao"), ("ais", "al"), ("eis", "el"), ("ois", "ol")]

STEM_ENDINGS = [
    "amento", "imento", "mente", "idade", "acao", "ados", "adas", "ado", "ada", "ido", "ida",
    "ando", "endo", "indo", "aram", "eram", "iram", "avam", "ava", "ar", "er", "ir", "am",
    "em", "ou", "eu", "iu", "a", "e", "o",
]

HARMLESS_EXTRAS = ["long", "empres", "companhi", "aere", "brasil", "geral", "tod", "total"]

MEASURE_WORDS = {
    "voos": ["voo", "voos", "movimento", "movimentos"],
    "origem": ["partida", "partidas", "partiram", "partiu", "decolaram", "decolou", "decolagem", "decolagens",
               "sairam", "saiu", "saem", "sai", "saindo", "partindo"],
    "destino": ["chegada", "chegadas", "chegaram", "chegou", "pousaram", "pousou", "pouso", "pousos", "chegando"],
    "otp": ["pontualidade", "pontual", "pontuais", "otp"],
    "cancelamento": ["cancelamento", "cancelamentos", "cancelado", "cancelados", "cancelada", "canceladas",
                     "cancelou", "cancelaram"],
    "atraso": ["atraso", "atrasos", "atrasam", "atrasou", "atrasaram", "atrasado", "atrasados"],
}
RATE_WORDS = ["taxa", "percentual", "porcentagem", "proporcao", "indice"]
SERIES_PATTERN = r"\b(por mes|mes a mes|mes por mes|cada mes|por meses|ao longo|mensal|mensalmente|evolucao)\b"
TEMPLATE_CONNECTORS = STOP_WORDS + (
    "quantidade numero total totais todos todas todo toda fez fizeram teve tem tiveram houve existem "
    "existiram saber quero queria gostaria diga mostre mostra mostrar ver medio media mes meses mensal "
    "mensalmente longo cada evolucao aeroporto aeroportos aerodromo aerodromos estado empresa companhia "
    "marca geral grupo"
).split()
TOWARD_WORDS = ["para", "pra", "pro", "destino", "ate"]

FOLLOW_UP_PATTERN = r"^(e|mas|agora|so|somente|apenas|tambem|entao|por|no|na|nos|nas|em|e no|e na|e em|e o|e a|e os|e as)\b"
FOLLOW_UP_WORDS = 6
BACK_REFERENCES = ["isso", "isto", "desses", "dessas", "deles", "delas", "nesse", "nessa", "nesses", "nessas",
                   "esse", "essa", "esses", "essas", "mesmo", "mesma", "anterior", "acima"]
LINK_WORDS = ["e", "de", "do", "da", "dos", "das", "em", "no", "na", "nos", "nas", "a", "o", "as", "os",
              "agora", "so", "tambem", "entao", "quanto", "sobre"]
PLACE_PREPOSITIONS = ["do", "no", "da", "na", "de", "em"]
AMBIGUOUS_CODES = ["SE", "PA", "PE", "MA", "GO", "TO", "ES", "AL", "AM", "AP"]
COMMON_WORD_NAMES = ["para", "patos", "breves", "sorriso", "franca", "palmas", "bonito", "una", "salinas",
                     "lencois", "pelotas", "borba", "cascavel", "guaira"]

# Ordered triggers over normalised text; the first that matches names the message.
TRIGGERS = [
    ("saudacao", r"^(oi+|ola|ole|opa|eai|e ai|hey|hello|hi|salve|fala|bom dia|boa tarde|boa noite)( (tudo bem|tudo bom|td bem|como vai|beleza|blz))?( agente)?$"),
    ("agradecimento", r"^(muito )?(obrigad[oa]|obg|valeu|vlw|brigad[oa]|thanks|thank you|grat[oa])( [a-z ]{0,30})?$"),
    ("identidade", r"\b(quem (e|eh) (voce|vc|tu)|quem (e|eh) o agente|o que (e|eh) (voce|vc)|quem (te|lhe) (criou|fez|desenvolveu)|qual (e )?(o )?seu nome|se apresent[ae]|voce (e|eh) (um |uma )?(robo|ia|bot|humano|pessoa))\b"),
    ("funcionamento", r"\b(como (voce|vc|isso|isto|o agente|esse agente|tu) funciona|de onde (vem|veem|saem) (os |esses |estes )?dados|qual (e )?(a )?fonte dos dados|como (voce|vc) (sabe|calcula|responde)|que dados (voce|vc) (usa|tem|consulta))\b|^como (isso |isto )?funciona$"),
    ("ajuda", r"^(ajuda|help|socorro|menu|exemplos?)$|\bo que (eu )?(posso|da pra|da para|consigo|devo) perguntar\b|\bo que (voce|vc) (sabe|faz|responde|consegue)\b|\b(me )?(de|da|mostre|mostra) (uns |alguns )?exemplos?\b|\bcomo (eu )?(uso|usar|pergunto|perguntar)\b"),
    ("fora_do_grao.motivo_cancelamento", r"\b(motivos?|razao|razoes|causas?|por que|porque|pq|justificativas?)\b.*\bcancel|\bcancel.*\b(motivos?|razao|razoes|causas?|por que|porque|pq|justificativas?)\b"),
    ("fora_do_grao.atraso_recuperado", r"\b(recuperad[oa]s?|recuperou|recuperar|recupera)\b.*\batras|\batras.*\b(recuperad[oa]s?|recuperou|recuperar|recupera)\b"),
    ("fora_do_grao.status_aerodromo", r"\bstatus (operacional )?d[oa]s? aero|\b(aeroporto|aerodromo) (esta |ta )?(aberto|fechado|interditado|operando)\b"),
    ("fora_do_grao.voo_especifico", r"\bnumero do voo\b|\bvoo (?!(de|da|do|em|no|na|um|eu|se|ao|os|as|ou|me|te|la)\b)(numero |n )?([a-z]{2}|[a-z][0-9]|[0-9][a-z]) ?[0-9]{2,4}\b|\bvoo (numero |n )?[0-9]{3,4}\b"),
    ("fora_do_grao.horario", r"\b(que horas|horario exato|horario do (voo|primeiro|ultimo)|as [0-9]{1,2} ?(h|hs|horas)|[0-9]{1,2}h[0-9]{2}|[0-9]{1,2}:[0-9]{2})\b"),
    ("fora_do_grao.por_dia", r"\b(dia [0-9]{1,2}|[0-9]{1,2} de (janeiro|fevereiro|marco|abril|maio|junho|julho|agosto|setembro|outubro|novembro|dezembro)|[0-9]{1,2}/[0-9]{1,2}|ontem|anteontem|hoje|amanha|semana passada|segunda feira|terca feira|quarta feira|quinta feira|sexta feira|sabado|domingo|vespera|reveillon|ano novo|carnaval|feriado)\b"),
]

# A greeting before the question itself.
GREETING_PREFIX = r"^(oi+|ola|opa|eai|e ai|bom dia|boa tarde|boa noite|salve|fala)( (tudo bem|tudo bom|beleza|blz))? "

MONTH_NAMES = ["janeiro", "fevereiro", "marco", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro", "novembro", "dezembro"]

# A number as written in Portuguese text, with an optional scale word.
NUMBER_PATTERN = (
    r"(?iu)(?<![\p{L}\p{N}_/.,])"
    r"(\d{1,3}(?:\.\d{3})+(?:,\d+)?|\d+(?:,\d+)?)"
    r"(?:\s*(mil|milh(?:ão|ões|ao|oes)|bilh(?:ão|ões|ao|oes))(?![\p{L}]))?"
    r"(?![\p{L}\p{N}_/])"
)
SMALL_INTEGER_MAX = 31

FORBIDDEN_SQL_WORDS = [
    "attach", "copy", "install", "load", "export", "import", "create", "insert", "update", "delete", "drop",
    "alter", "pragma", "set", "read_csv", "read_parquet", "read_json", "glob", "system", "shell",
]
SQL_ROW_CAP = 100

STATE_CODES = {
    "Acre": "AC", "Alagoas": "AL", "Amapá": "AP", "Amazonas": "AM", "Bahia": "BA", "Ceará": "CE",
    "Distrito Federal": "DF", "Espírito Santo": "ES", "Goiás": "GO", "Maranhão": "MA", "Mato Grosso": "MT",
    "Mato Grosso do Sul": "MS", "Minas Gerais": "MG", "Pará": "PA", "Paraíba": "PB", "Paraná": "PR",
    "Pernambuco": "PE", "Piauí": "PI", "Rio de Janeiro": "RJ", "Rio Grande do Norte": "RN",
    "Rio Grande do Sul": "RS", "Rondônia": "RO", "Roraima": "RR", "Santa Catarina": "SC", "São Paulo": "SP",
    "Sergipe": "SE", "Tocantins": "TO",
}
BRANDS = {"TAM": "LATAM", "LAN": "LATAM", "LPE": "LATAM", "LNE": "LATAM", "GLO": "GOL", "AZU": "AZUL", "ACN": "AZUL"}
LINE_TYPES = {"N": "Nacional", "I": "Internacional", "G": "Geral/Privado", "C": "Cargueiro/Charter"}
STATUS_LABELS = {"REALIZADO": "Voo realizado normalmente", "CANCELADO": "Voo cancelado"}
AIRPORT_STATUS = {"CADASTRADO": "cadastrado", "INTERDITADO": "interditado"}
DOMESTIC_CODE_PATTERN = "^S[BDIJNSW]"
# ----------------------------------------------------------------------------------------------
