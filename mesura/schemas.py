"""Schemas, code-to-label maps, literal dimension rows and relationships.

Everything between the two FIXED VALUES markers is data that must equal the
surveyed system's values for results to match (labels, codes, band edges,
parameter-table rows). It is written out plainly, in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

UNKNOWN = "Sin información"

# ---------------------------------------------------------------- FIXED VALUES
DWELLING_TYPE = {1: "Casa", 2: "Apartamento", 3: "Cuarto",
                 4: "Otro tipo de unidad de vivienda", 5: "Vivienda indígena"}
WALL_MATERIAL = {0: "Sin paredes", 1: "Bloque, ladrillo, piedra, madera pulida",
                 2: "Tapia pisada o adobe", 3: "Bahareque", 4: "Material prefabricado",
                 5: "Madera burda, tabla o tablón", 6: "Guadua, caña u otro vegetal",
                 7: "Zinc, tela, lona, cartón, desechos"}
SERVICE = {1: "Sí tiene servicio", 2: "No tiene servicio"}
AREA_CLASS = {1: "Urbano", 2: "Urbano", 3: "Rural"}
SANITARY = {1: "Con conexión a alcantarillado", 2: "Con conexión a pozo séptico",
            3: "Sin conexión a alcantarillado ni pozo", 4: "Letrina o bajamar", 5: "No tiene"}
HEAD_SEX = {1: "Hombre jefe", 2: "Mujer jefe"}
FLOOR_MATERIAL = {1: "Alfombra o tapete, mármol, parqué, madera pulida y lacada",
                  2: "Baldosa, vinilo, tableta, ladrillo", 3: "Cemento, gravilla",
                  4: "Madera burda, madera en mal estado, tabla, tablón",
                  5: "Tierra o arena", 6: "Otro"}
TENURE = {1: "Arriendo o subarriendo", 2: "Propia pagando", 3: "Propia pagada",
          4: "Con permiso", 5: "Posesión sin título"}
HEALTH_REGIME = {0: "Ninguno", 1: "Contributivo", 2: "Especial", 3: "Subsidiado", 9: "No sabe"}
CLASS_ORDER = {"A": 1, "B": 2, "C": 3, "D": 4}
CLASS_ORDER_DEFAULT = 99

# Five-year age bands: (upper bound inclusive, label); the last band is open.
AGE_BANDS = [(4, "00-04"), (9, "05-09"), (14, "10-14"), (19, "15-19"), (24, "20-24"),
             (29, "25-29"), (34, "30-34"), (39, "35-39"), (44, "40-44"), (49, "45-49"),
             (54, "50-54"), (59, "55-59"), (64, "60-64"), (69, "65-69"), (74, "70-74"),
             (79, "75-79"), (None, "80+")]

HOUSING_QUALITY = ("Sin privaciones", "Privación moderada", "Privación alta")
CROWDED, NOT_CROWDED = "Hacinado", "No hacinado"

# State dimension: code, reason, macro category.
STATE_ROWS = [
    (0, "Registro Válido", "Válido"),
    (10, "Excluido - Fallecido", "Excluido"),
    (30, "Verificación - jefe de hogar - Por Denuncia", "Verificación"),
    (31, "Verificación - miembros del hogar - Por Denuncia", "Verificación"),
    (32, "Verificación - Por Denuncia - Inconsistencias en procedimiento", "Verificación"),
    (40, "Verificación - Desactualización - ind_está_embarazada", "Verificación"),
    (41, "Verificación - Desactualización - niv_educativo", "Verificación"),
    (42, "Verificación - Desactualización - Ind_fondo_pensiones", "Verificación"),
    (43, "Verificación - Desactualización - Ocupación e ingresos", "Verificación"),
    (44, "Verificación - Desactualización - actividad principal", "Verificación"),
    (50, "Verificación - Calidad - Movimiento atípico entre fichas", "Verificación"),
    (51, "Verificación - Calidad - Inclusión atípica en hogar", "Verificación"),
    (52, "Verificación - Calidad - Número atípico hogar con discapacidad", "Verificación"),
    (53, "Verificación - Calidad - Número atípico no parientes", "Verificación"),
    (54, "Verificación - Calidad - Número atípico otro parentesco", "Verificación"),
    (55, "Verificación - Calidad - Inclusión atípica no parientes u otros", "Verificación"),
    (60, "Calidad - Datos no válidos en la encuesta (cálculo/fechas)", "Excluido"),
    (61, "Verificación - Calidad - Parentescos inconsistentes", "Verificación"),
    (62, "Verificación - Calidad - grado_alcanzado", "Verificación"),
    (63, "Verificación - Calidad - Antecedentes Sociodemograficos", "Verificación"),
    (64, "Verificación - Calidad - inconsistencia hijos embarazo", "Verificación"),
    (65, "Verificación - Calidad - Ocupación e ingresos", "Verificación"),
    (66, "Verificación - Calidad - Vivienda", "Verificación"),
    (67, "Verificación - Calidad - Hogares", "Verificación"),
    (68, "Verificación - Calidad - num_cuartos_vivienda", "Verificación"),
    (69, "Verificación - Calidad - Distancia de la encuesta a vivienda", "Verificación"),
    (70, "Excluido - Calidad - Documento no válido", "Excluido"),
    (71, "Excluido - Calidad - Número documento duplicado", "Excluido"),
    (90, "Verificación - Calidad - Desmejoramiento vivienda", "Verificación"),
    (91, "Verificación - Calidad - Desmejoramiento nivel educativo", "Verificación"),
    (92, "Verificación - Calidad - Desmejoramiento ocupación", "Verificación"),
]
MARK_ROWS = [(0, "Registro Válido"), (1, "Excluido de Publicación"),
             (10, "Verificación Persona"), (20, "Verificación Oficina")]

# State codes counted by the three quality matrices.
OFFICE_CHECK_STATES = ["60", "63", "64", "65", "66", "67", "68", "69"]
COORDINATOR_STATES = ["50", "51", "52", "53", "54", "55", "61", "69", "90", "91", "92"]

# Multidimensional-poverty indicators I1..I15: label, category.
INDICATOR_ROWS = [
    ("Bajo logro educativo", "Educación"),
    ("Analfabetismo", "Educación"),
    ("Inasistencia escolar", "Educación"),
    ("Rezago escolar", "Educación"),
    ("Barreras primera infancia", "Niñez y juventud"),
    ("Trabajo infantil", "Niñez y juventud"),
    ("Desempleo larga duración", "Trabajo"),
    ("Trabajo informal", "Trabajo"),
    ("Sin aseguramiento en salud", "Salud"),
    ("Barreras acceso salud", "Salud"),
    ("Sin acceso a agua", "Vivienda y servicios"),
    ("Eliminación inadecuada de excretas", "Vivienda y servicios"),
    ("Material inadecuado de pisos", "Vivienda y servicios"),
    ("Material inadecuado de paredes", "Vivienda y servicios"),
    ("Hacinamiento crítico", "Vivienda y servicios"),
]

# Household indicators: label, category (type = "Gasto" when the label holds it).
HOUSEHOLD_INDICATOR_ROWS = [
    ("% Agua disponible 7 días", "Condiciones básicas"),
    ("% Con cocina", "Condiciones básicas"),
    ("% Con nevera", "Equipamiento"),
    ("% Con lavadora", "Equipamiento"),
    ("% Con computador", "Equipamiento"),
    ("% Con internet", "Equipamiento"),
    ("% Con moto", "Movilidad"),
    ("% Con carro", "Movilidad"),
    ("% Con tractor", "Movilidad"),
    ("% Con otra propiedad", "Movilidad"),
    ("Gasto promedio alimentación", "Gastos del hogar"),
    ("Gasto promedio transporte", "Gastos del hogar"),
    ("Gasto promedio educación", "Gastos del hogar"),
    ("Gasto promedio salud", "Gastos del hogar"),
    ("Gasto promedio servicios públicos", "Gastos del hogar"),
    ("Gasto promedio celular", "Gastos del hogar"),
    ("Gasto promedio arriendo", "Gastos del hogar"),
    ("Gasto promedio otros", "Gastos del hogar"),
    ("Gasto promedio total", "Gastos del hogar"),
]

# Housing categories: label, type. Floor labels follow the floor-material
# code labels so that every row has a branch (one shared label list).
HOUSING_CATEGORY_ROWS = [
    ("Alfombra o tapete, mármol, parqué, madera pulida y lacada", "Pisos"),
    ("Baldosa, vinilo, tableta, ladrillo", "Pisos"),
    ("Cemento, gravilla", "Pisos"),
    ("Madera burda, madera en mal estado, tabla, tablón", "Pisos"),
    ("Tierra o arena", "Pisos"),
    ("Otro", "Pisos"),
    ("Sin paredes", "Paredes"),
    ("Bloque, ladrillo, piedra, madera pulida", "Paredes"),
    ("Tapia pisada o adobe", "Paredes"),
    ("Bahareque", "Paredes"),
    ("Material prefabricado", "Paredes"),
    ("Madera burda, tabla o tablón", "Paredes"),
    ("Guadua, caña u otro vegetal", "Paredes"),
    ("Zinc, tela, lona, cartón, desechos", "Paredes"),
    ("Paredes inadecuadas", "Servicios"),
    ("Pisos inadecuados", "Servicios"),
    ("Sin energía", "Servicios"),
    ("Sin gas", "Servicios"),
    ("Sin acueducto", "Servicios"),
    ("Sin alcantarillado", "Servicios"),
    ("Sin recolección", "Servicios"),
]
HOUSING_TYPE_ROWS = ["Pisos", "Paredes", "Servicios"]

# Service-absence heat map: label, dimension.
HOUSING_INDICATOR_ROWS = [
    ("Paredes inadecuadas", "Condición Estructural"),
    ("Pisos inadecuados", "Condición Estructural"),
    ("Sin energía", "Acceso a Servicios Públicos"),
    ("Sin gas", "Acceso a Servicios Públicos"),
    ("Sin acueducto", "Acceso a Servicios Públicos"),
    ("Sin alcantarillado", "Acceso a Servicios Públicos"),
    ("Sin recolección", "Acceso a Servicios Públicos"),
]
EVENT_ROWS = ["Inundación", "Avalancha", "Terremoto", "Incendio", "Vendaval", "Hundimiento"]
DEPRIVATION_ROWS = ["Agua", "Saneamiento", "Pisos", "Paredes", "Hacinamiento"]
SANITARY_BLOCK_ROWS = ["Tipo de sanitario", "Ubicación del sanitario", "Uso del sanitario",
                       "Origen del agua"]
LEVEL_ROWS = ["grupo_sisben", "subgrupo_detallado"]

# Text pieces of the measures that build sentences.
TXT_MILLIONS = " millones de personas"
TXT_MAX_IPM = " registra mayor IPM con "
TXT_RISE = " registra el mayor incremento ("
TXT_FALL = " presenta la mayor reducción ("
TXT_PP = " pp)"
TXT_ALL = "Todas"
TXT_OVERVIEW = "Visión General: Departamento de Antioquia"
TXT_SELECTION = "Selección de Filtros: "
TXT_SUBREGION_ALL = "Todas las subregiones"
TXT_POVERTY_MILLIONS = " millones de personas en grupos A&B"
TXT_MPI_HEATMAP = "Privaciones IPM por dimensión – "
TXT_ALL_CATEGORIES = "Todas las categorías"
TXT_HOUSEHOLD_HEATMAP = "Condiciones y gastos de los hogares por subregión – "
TXT_SELECTED_YEAR = "Año selecionado "
TXT_MPI_CARD = " Personas IPM  |  "
# Service problems in the order the dominant-problem test checks them.
SERVICE_PROBLEMS = [("Sin energía", "pct_no_energy"), ("Sin gas", "pct_no_gas"),
                    ("Sin acueducto", "pct_no_water_supply"),
                    ("Sin alcantarillado", "pct_no_sewer"),
                    ("Sin recolección", "pct_no_waste_collection")]

# Population projections: sex and area labels.
SEX_CODES = {"Hombres": 1, "Mujeres": 2}
TOWN_CENTRE = "Cabecera Municipal"

# Municipality-name aliases used when matching resource file names (J4):
# normalised dimension name -> normalised file name.
NAME_ALIASES = [
    ("santafe_de_antioquia", "santafedeantioquia"),
    ("medellin", "distritoespecialdeciencia,tecnologiaeinnovaciondemedellin"),
    ("turbo", "distritoportuario,logistico,industrial,turisticoycomercialdeturbo"),
    ("carolina", "carolinadelprincipe"),
    ("retiro", "elretiro"),
    ("laceja", "lacejadeltambo"),
    ("penol", "elpenol"),
]

# Header rules: (canonical name, prefix, parts it holds, shorter than). Names
# are compared in lower case with '?' read as 'ñ'; the last rule that fits wins.
SURVEY_HEADERS = [
    ("ind_discap_bañarse", "ind_discap_ba", ("arse",), None),
    ("tip_cuidado_niños", "tip_cuidado_ni", ("os",), None),
    ("Num_evento_vendaval", "num_evento_vendaval", (), 20),
]
POPULATION_HEADERS = [
    ("DPMP", "", ("dpmp",), None),
    ("AÑO", "", ("ao",), None),
    ("AÑO", "", ("a", "o"), 5),
    ("Genero", "", ("genero",), None),
    ("AREA_TXT", "", ("rea", "geogr"), None),
    ("Edad_Num", "", ("edad_num",), None),
    ("Pob", "", ("pob",), 5),
]

# Columns of the survey file read as integers, and as text.
INTEGER_COLUMNS = """
Cod_clase tip_vivienda tip_mat_paredes tip_mat_pisos ind_tiene_energia tip_estrato_energia ind_tiene_alcantarillado ind_tiene_gas
ind_tiene_recoleccion ind_tiene_acueducto tip_estrato_acueducto num_cuartos_vivienda num_hogares_vivienda ide_hogar tip_ocupa_vivienda
num_cuartos_exclusivos num_cuartos_dormir num_cuartos_unicos_dormir tip_sanitario tip_ubi_sanitario tip_uso_sanitario tip_origen_agua
ind_agua_llega_7dias num_dias_llega ind_agua_llega_24horas num_horas_llega tip_uso_agua_beber tip_elimina_basura ind_tiene_cocina
tip_prepara_alimentos tip_uso_cocina tip_energia_cocina ind_tiene_nevera ind_tiene_lavadora ind_tiene_pc ind_tiene_internet ind_tiene_moto
ind_tiene_tractor ind_tiene_carro ind_tiene_bien_raiz ind_gasto_alimento vlr_gasto_alimento ind_gasto_transporte vlr_gasto_transporte
ind_gasto_educacion vlr_gasto_educacion ind_gasto_salud vlr_gasto_salud ind_gasto_serv_publicos vlr_gasto_serv_publicos ind_gasto_celular
vlr_gasto_celular ind_gasto_arriendo vlr_gasto_arriendo ind_gasto_otros vlr_gasto_otros vlr_total_gastos num_habita_vivienda
ind_evento_inundacion num_evento_inundacion ind_evento_avalancha num_evento_avalancha ind_evento_terremoto num_evento_terremoto
ind_evento_incendio num_evento_incendio ind_evento_vendaval Num_evento_vendaval ind_evento_hundimiento num_evento_hundimiento
num_personas_hogar sexo_persona tip_parentesco tip_estado_civil ind_conyuge_vive_hogar ide_conyuge ind_padre_vive_hogar ide_padre
ind_pariente_domestico ide_serv_domestico ind_discap_ver ind_discap_oir ind_discap_hablar ind_discap_moverse ind_discap_bañarse
ind_discap_salir ind_discap_entender ind_discap_ninguna tip_seg_social ind_enfermo_30 ind_acudio_salud ind_fue_atendido_salud
ind_esta_embarazada ind_tuvo_hijos tip_cuidado_niños ind_recibe_comida ind_leer_escribir ind_estudia niv_educativo grado_alcanzado
ind_fondo_pensiones tip_actividad_mes num_sem_buscando tip_empleado ind_ingr_salario vlr_ingr_salario ind_ingr_honorarios
vlr_ingr_honorarios ind_ingr_cosecha vlr_ingr_cosecha ind_ingr_pension vlr_ingr_pension ind_ingr_remesa_pais vlr_ingr_remesa_pais
ind_ingr_remesa_exterior vlr_ingr_remesa_exterior ind_ingr_arriendos vlr_ingr_arriendos ind_otros_ingresos vlr_otros_ingresos
ind_ingr_estado vlr_ingr_fam_accion vlr_ingr_col_mayor vlr_ingr_otro_subsidio H_5 I1 I2 I3 I4 I5 I6 I7 I8 I9 I10 I11 I12 I13 I14 I15 Edad anio
""".split()
TEXT_COLUMNS = ("NOM_BARRIO", "NOM_CORREGIMIENTO", "NOM_VEREDA", "Clasificacion", "grupo_sisben", "Fec_digitacion", "marca", "estado", "filename")

# Column order of the latest-year extract.
EXTRACT_PRIORITY = ["cod_mpio", "NOM_MUNICIPIO", "Cod_clase", "NOM_BARRIO", "Clasificacion", "grupo_sisben", "anio"]

# Area labels of the projection sheets.
TOWN_LABEL, RURAL_LABEL, TOTAL_LABEL = "Cabecera", "Centros Poblados y Rural Disperso", "Total"

# Subregion names as the title writes them.
SUBREGION_TITLES = {"VALLE DE ABURRA": "Valle de Aburra", "BAJO CAUCA": "Bajo Cauca", "MAGDALENA MEDIO": "Magdalena Medio",
                    "NORDESTE": "Nordeste", "NORTE": "Norte", "OCCIDENTE": "Occidente", "ORIENTE": "Oriente",
                    "SUROESTE": "Suroeste", "URABA": "Uraba"}

# Relationships of the model: (table, column, dimension, column).
RELATIONSHIPS = [
    ("fact", "cod_mpio", "territory", "cod_mpio"),
    ("population", "cod_mpio", "territory", "cod_mpio"),
    ("population", "anio", "years", "anio"),
    ("population", "Rango_Edad", "age_band", "Rango_Edad"),
    ("fact", "estado", "state", "Cod_Estado"),
    ("fact", "anio", "years", "anio"),
    ("households", "cod_mpio", "territory", "cod_mpio"),
    ("households", "anio", "years", "anio"),
    ("dwellings", "cod_mpio", "territory", "cod_mpio"),
    ("dwellings", "anio", "years", "anio"),
]
# ---------------------------------------------------------------- FIXED VALUES

TERRITORY_COLUMNS = ("cod_mpio", "Municipio", "Subregion")

DERIVED_COLUMNS = [
    "orden_clasificacion", "Tipo_Vivienda_txt", "Material de las Paredes",
    "Energia_txt", "Acueducto_txt", "Alcantarillado_txt", "Gas_txt", "Recoleccion_txt",
    "Clase_txt", "Sanitario_txt", "Privaciones_Vivienda", "Nivel_Calidad_Vivienda", "Zona",
    "Es_Jefe", "Sexo_Jefe", "Sexo_Jefe_Label", "Personas_por_Cuarto", "Cat_Hacinamiento",
    "Material del Piso", "Orden_Paredes", "Tipo_Ocupacion_txt", "Rango_Edad", "Orden_Edad",
    "Regimen_Salud_Limpio",
]

def literal_schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])
