"""The registered queries in plain SQL over the star-schema tables, written from their definition."""

from __future__ import annotations

import re

from anaquel.plans.rules import MAIL

AS_OF = "DATE '2001-08-01'"
RUN_TIME = "TIMESTAMP '2001-08-01 12:00:00'"

TITLE = "p_name || ' #' || CAST(p_partkey AS VARCHAR)"
MAIL_OF = (
    "CASE WHEN c_custkey % 53 = 0 THEN replace(c_name, '#', '.') "
    "ELSE lower(replace(c_name, '#', '.')) || '@example.com' END"
)
STATUS = "CASE WHEN o_orderstatus = 'O' THEN 'Activo' ELSE 'Devuelto' END"
RATING = "CAST(trunc(value) AS INTEGER) % 7"


def _date(text: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({text}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') "
        f"THEN CAST(try_strptime({text}, '%Y-%m-%d') AS DATE) END"
    )


def _int(text: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({text}), '[+-]?[0-9]+') THEN TRY_CAST({text} AS INTEGER) END"


def _name_part(n: int) -> str:
    return f"trim(split_part(categoria_y_descripcion, '/', {n}))"


def _each(listed: str, name: str, rest: str, select: str) -> str:
    """Every element of a list of ``select``, ``n`` times, with the columns ``rest``."""
    return f"SELECT unnest({listed}) AS {name}, {rest} FROM (SELECT {listed}, {rest}, unnest(range(n)) FROM ({select}))"


def _ids(order: str) -> str:
    return "row_number() OVER (ORDER BY " + ", ".join(f"{c} NULLS FIRST" for c in order.split(", ")) + ")"


# More draws than any loan needs: with three expected links, the 64th is past the last book but for one loan in 10^50.
RANDOM_LINKS = """
    SELECT id_prestamo, id_libro FROM (
        SELECT id_prestamo, n, CAST(sum(1 + CAST(floor(ln(u) / ln(1 - p)) AS BIGINT)) OVER (PARTITION BY id_prestamo ORDER BY j) AS BIGINT) AS id_libro
        FROM (SELECT id_prestamo, j, n, CAST(3 AS DOUBLE) / n AS p,
                     CAST(CAST('0x' || substr(md5('|' || id_prestamo || '|' || j), 1, 13) AS BIGINT) + 1 AS DOUBLE) / pow(16, 13) AS u
              FROM (SELECT id_prestamo, unnest(range(1, 65)) AS j FROM m_prestamos), (SELECT count(*) AS n FROM m_libros)))
    WHERE id_libro <= n"""

# Every loan with every book, three of ten pairs.
DRAWN_PAIRS = """
    SELECT id_prestamo, id_libro FROM (
        SELECT id_prestamo, id_libro, (factor * (id_libro % 2147483647) + shift) % 2147483647 AS t
        FROM (SELECT id_prestamo, 1 + CAST('0x' || substr(md5('|' || id_prestamo), 1, 13) AS BIGINT) % 2147483646 AS factor,
                     CAST('0x' || substr(md5('|' || id_prestamo), 14, 13) AS BIGINT) % 2147483647 AS shift FROM e_prestamos)
        CROSS JOIN (SELECT id_libro FROM e_libros))
    WHERE (t * t % 2147483647) * (t * t % 2147483647) % 2147483647 * t % 2147483647 < 644245094"""

# Named tables; each may use those before it.
TABLES = {
    # Raw tables.
    "lg_biblioteca": f"""
        SELECT p_partkey AS id_registro, {TITLE} AS titulo_libro, 'Autor ' || CAST(p_partkey % 50 AS VARCHAR) AS autor_nombre,
               CASE WHEN p_partkey % 43 = 0 THEN p_type ELSE p_type || ' / ' || p_brand END AS categoria_y_descripcion,
               CASE WHEN p_partkey % 41 = 0 THEN ' ' || p_brand ELSE p_brand END AS editorial_info,
               CASE WHEN p_partkey % 97 = 0 THEN 'N/A' WHEN p_partkey % 89 = 0 THEN '2024-02-30'
                    WHEN p_partkey % 83 = 0 THEN NULL
                    ELSE CAST(2000 + p_partkey % 25 AS VARCHAR) || '-' || CAST(1 + p_partkey % 12 AS VARCHAR) || '-'
                         || CAST(1 + p_partkey % 28 AS VARCHAR) END AS fecha_publicacion
        FROM part""",
    "lg_prestamos": f"""
        SELECT o_orderkey AS id_prestamo, c_name AS nombre_usuario, {MAIL_OF} AS correo_usuario,
               t.titles AS libros_prestados, CAST(o_orderdate AS DATE) AS fecha_salida, {STATUS} AS estado_prestamo
        FROM orders JOIN customer ON o_custkey = c_custkey
        LEFT JOIN (SELECT l_orderkey, string_agg(title, ', ' ORDER BY title) AS titles
                   FROM (SELECT DISTINCT l_orderkey, {TITLE} AS title FROM lineitem JOIN part ON l_partkey = p_partkey)
                   GROUP BY l_orderkey) t ON o_orderkey = l_orderkey""",
    "lg_inventario": f"""
        SELECT n_name AS sede_nombre, r_name || ', ' || n_name AS ubicacion_sede, {TITLE} AS libro_asociado,
               CAST(sum(l_quantity) AS BIGINT) AS cantidad_total
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
        GROUP BY ALL""",
    "lg_resenas": f"""
        SELECT user_id AS usuario_id, {TITLE} AS libro_titulo, event_type AS comentario,
               CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 103 = 0 THEN 'cinco'
                    ELSE CAST({RATING} AS VARCHAR) END AS calificacion
        FROM events JOIN part ON p_partkey = event_id % (SELECT count(*) FROM part)""",
    # Compatible migration.
    "e_editoriales": f"""
        SELECT {_ids('nombre')} AS id_editorial, nombre FROM (SELECT DISTINCT editorial_info AS nombre FROM lg_biblioteca)""",
    "e_libros": f"""
        SELECT {_ids('id_registro, id_editorial')} AS id_libro, titulo_libro AS titulo,
               {_date('fecha_publicacion')} AS fecha_publicacion, id_editorial, id_registro
        FROM lg_biblioteca JOIN e_editoriales ON trim(editorial_info) = trim(nombre)""",
    "e_autores": f"""
        SELECT {_ids('nombre')} AS id_autor, nombre FROM (SELECT DISTINCT autor_nombre AS nombre FROM lg_biblioteca)""",
    # Ids listed per key. A raw key with n rows and lists of a and b ids gives n times a times b rows.
    "por_titulo": "SELECT trim(titulo) AS clave, list(id_libro) AS libros FROM e_libros GROUP BY ALL",
    "por_autor": "SELECT trim(nombre) AS clave, list(id_autor) AS autores FROM e_autores GROUP BY ALL",
    "e_libro_autor": f"""
        SELECT id_libro, unnest(autores) AS id_autor FROM ({_each('libros', 'id_libro', 'autores', """
            SELECT libros, autores, n
            FROM (SELECT trim(titulo_libro) AS t, trim(autor_nombre) AS a, count(*) AS n FROM lg_biblioteca GROUP BY ALL)
            JOIN por_titulo ON por_titulo.clave = t JOIN por_autor ON por_autor.clave = a""")})""",
    "e_categorias": f"""
        SELECT {_ids('nombre, descripcion')} AS id_categoria, nombre, descripcion
        FROM (SELECT DISTINCT {_name_part(1)} AS nombre, {_name_part(2)} AS descripcion FROM lg_biblioteca)""",
    "por_categoria": "SELECT trim(nombre) AS clave, list(id_categoria) AS categorias FROM e_categorias GROUP BY ALL",
    "e_libro_categoria": f"""
        SELECT id_libro, unnest(categorias) AS id_categoria FROM ({_each('libros', 'id_libro', 'categorias', f"""
            SELECT libros, categorias, n
            FROM (SELECT trim(titulo_libro) AS t, {_name_part(1)} AS c, count(*) AS n FROM lg_biblioteca GROUP BY ALL)
            JOIN por_titulo ON por_titulo.clave = t JOIN por_categoria ON por_categoria.clave = c""")})""",
    "e_usuarios": f"""
        SELECT {_ids('nombre, correo')} AS id_usuario, nombre, correo
        FROM (SELECT DISTINCT nombre_usuario AS nombre, correo_usuario AS correo FROM lg_prestamos)""",
    "por_correo": "SELECT trim(correo) AS clave, list(id_usuario) AS usuarios FROM e_usuarios GROUP BY ALL",
    "e_prestamos": f"""
        SELECT {_ids('crudo, id_usuario, fecha_salida, estado')} AS id_prestamo, id_usuario, fecha_salida, estado, libros_prestados
        FROM (SELECT id_prestamo AS crudo, fecha_salida, estado_prestamo AS estado, libros_prestados,
                     unnest((SELECT usuarios FROM por_correo WHERE clave = trim(correo_usuario))) AS id_usuario FROM lg_prestamos)""",
    "e_prestamo_libro": """
        SELECT DISTINCT id_prestamo, id_libro
        FROM (SELECT id_prestamo, trim(unnest(string_split(libros_prestados, ','))) AS entrada FROM e_prestamos)
        JOIN e_libros ON entrada = trim(titulo)""",
    "e_resenas": f"""
        SELECT {_ids('id_usuario, t, comentario, nota, id_libro')} AS id_resena, id_usuario, id_libro, comentario, nota AS calificacion
        FROM (SELECT usuario_id AS id_usuario, trim(libro_titulo) AS t, comentario, {_int('calificacion')} AS nota,
                     unnest((SELECT libros FROM por_titulo WHERE clave = trim(libro_titulo))) AS id_libro
              FROM lg_resenas WHERE usuario_id IN (SELECT id_usuario FROM e_usuarios))""",
    "e_sedes": f"""
        SELECT {_ids('nombre, ubicacion')} AS id_sede, nombre, ubicacion
        FROM (SELECT DISTINCT sede_nombre AS nombre, ubicacion_sede AS ubicacion FROM lg_inventario)""",
    "por_sede": "SELECT trim(nombre) AS clave, list(id_sede) AS sedes FROM e_sedes GROUP BY ALL",
    "e_inventario": f"""
        SELECT unnest(sedes) AS id_sede, id_libro, cantidad FROM ({_each('libros', 'id_libro', 'sedes, cantidad', """
            SELECT libros, sedes, cantidad, n
            FROM (SELECT trim(sede_nombre) AS s, trim(libro_asociado) AS t, cantidad_total AS cantidad, count(*) AS n
                  FROM lg_inventario GROUP BY ALL)
            JOIN por_titulo ON por_titulo.clave = t JOIN por_sede ON por_sede.clave = s""")})""",
    # Strict migration.
    "s_editoriales": f"""
        SELECT {_ids('nombre')} AS id_editorial, nombre
        FROM (SELECT DISTINCT trim(editorial_info) AS nombre FROM lg_biblioteca) WHERE nombre IS NOT NULL""",
    "s_libros": f"""
        SELECT {_ids('id_registro, id_editorial')} AS id_libro, titulo_libro AS titulo,
               {_date('fecha_publicacion')} AS fecha_publicacion, id_editorial, id_registro
        FROM lg_biblioteca LEFT JOIN s_editoriales ON trim(editorial_info) = nombre""",
    "s_autores": f"""
        SELECT {_ids('nombre')} AS id_autor, nombre
        FROM (SELECT DISTINCT trim(autor_nombre) AS nombre FROM lg_biblioteca) WHERE nombre IS NOT NULL""",
    "s_libro_autor": """
        SELECT DISTINCT id_libro, id_autor FROM lg_biblioteca b JOIN s_libros USING (id_registro)
        JOIN s_autores ON trim(autor_nombre) = nombre""",
    "s_categorias": f"""
        SELECT {_ids('nombre, descripcion')} AS id_categoria, nombre, descripcion
        FROM (SELECT DISTINCT {_name_part(1)} AS nombre, {_name_part(2)} AS descripcion FROM lg_biblioteca)
        WHERE nombre IS NOT NULL""",
    "s_libro_categoria": f"""
        SELECT DISTINCT id_libro, id_categoria FROM lg_biblioteca b JOIN s_libros USING (id_registro)
        JOIN s_categorias ON {_name_part(1)} = nombre AND {_name_part(2)} = descripcion""",
    "s_usuarios": f"""
        SELECT {_ids('nombre, correo')} AS id_usuario, nombre, correo
        FROM (SELECT DISTINCT trim(nombre_usuario) AS nombre, trim(correo_usuario) AS correo FROM lg_prestamos)""",
    "s_prestamos_lista": f"""
        SELECT {_ids('p.id_prestamo, u.id_usuario, fecha_salida, estado_prestamo, libros_prestados')} AS id_prestamo,
               id_usuario, fecha_salida, estado_prestamo AS estado, libros_prestados
        FROM lg_prestamos p LEFT JOIN s_usuarios u
        ON trim(p.nombre_usuario) = u.nombre AND trim(p.correo_usuario) = u.correo""",
    "s_prestamos": "SELECT id_prestamo, id_usuario, fecha_salida, estado FROM s_prestamos_lista",
    "s_titulos": "SELECT trim(titulo) AS title, min(id_libro) AS id_libro FROM s_libros GROUP BY trim(titulo)",
    "s_prestamo_libro": """
        SELECT DISTINCT id_prestamo, id_libro
        FROM (SELECT id_prestamo, trim(unnest(string_split(libros_prestados, ','))) AS title FROM s_prestamos_lista)
        JOIN s_titulos USING (title)""",
    "s_resenas": f"""
        SELECT {_ids('id_usuario, title, comentario, nota, id_libro')} AS id_resena, id_usuario, id_libro,
               comentario, nota AS calificacion
        FROM (SELECT *, {_int('calificacion')} AS nota FROM lg_resenas) r
        JOIN s_titulos ON trim(r.libro_titulo) = title JOIN s_usuarios u ON u.id_usuario = r.usuario_id""",
    "s_sedes": f"""
        SELECT {_ids('nombre, ubicacion')} AS id_sede, nombre, ubicacion
        FROM (SELECT DISTINCT trim(sede_nombre) AS nombre, trim(ubicacion_sede) AS ubicacion FROM lg_inventario)""",
    "s_inventario": """
        SELECT * FROM (
            SELECT (SELECT id_sede FROM s_sedes WHERE nombre = trim(sede_nombre) AND ubicacion = trim(ubicacion_sede)) AS id_sede,
                   (SELECT id_libro FROM s_titulos WHERE title = trim(libro_asociado)) AS id_libro, cantidad_total AS cantidad
            FROM lg_inventario)
        WHERE id_sede IS NOT NULL AND id_libro IS NOT NULL""",
    # Library tables with the keys of the star schema.
    "m_editoriales": """
        SELECT DISTINCT CAST(split_part(p_brand, '#', 2) AS BIGINT) AS id_editorial, p_brand AS nombre FROM part""",
    "m_libros": f"""
        SELECT p_partkey AS id_libro, {TITLE} AS titulo,
               make_date(2000 + p_partkey % 25, 1 + p_partkey % 12, 1 + p_partkey % 28) AS fecha_publicacion,
               CAST(split_part(p_brand, '#', 2) AS BIGINT) AS id_editorial
        FROM part""",
    "m_autores": "SELECT s_suppkey AS id_autor, s_name AS nombre FROM supplier",
    "m_libro_autor": """
        SELECT DISTINCT l_partkey AS id_libro, l_suppkey AS id_autor FROM lineitem
        WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL""",
    "m_categorias": """
        SELECT CAST(n_nationkey AS BIGINT) AS id_categoria, n_name AS nombre, r_name || ', ' || n_name AS descripcion
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "m_libro_categoria": """
        SELECT DISTINCT l_partkey AS id_libro, CAST(s_nationkey AS BIGINT) AS id_categoria
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_partkey IS NOT NULL""",
    "m_usuarios": f"SELECT c_custkey AS id_usuario, c_name AS nombre, {MAIL_OF} AS correo FROM customer",
    "m_prestamos": f"""
        SELECT o_orderkey AS id_prestamo, o_custkey AS id_usuario, CAST(o_orderdate AS DATE) AS fecha_salida,
               {STATUS} AS estado FROM orders""",
    "m_prestamo_libro": """
        SELECT DISTINCT l_orderkey AS id_prestamo, l_partkey AS id_libro FROM lineitem
        WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL""",
    "m_sedes": "SELECT id_categoria AS id_sede, nombre, descripcion AS ubicacion FROM m_categorias",
    "m_inventario": """
        SELECT CAST(s_nationkey AS BIGINT) AS id_sede, l_partkey AS id_libro,
               CASE WHEN l_partkey % 37 <> 0 THEN CAST(sum(l_quantity) AS BIGINT) END AS cantidad
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_partkey IS NOT NULL GROUP BY s_nationkey, l_partkey""",
    "m_resenas": f"""
        SELECT event_id AS id_resena, user_id AS id_usuario, event_id % (SELECT count(*) FROM part) AS id_libro,
               event_type AS comentario, CASE WHEN event_id % 101 <> 0 THEN {RATING} END AS calificacion FROM events""",
    # Lists of the documents; none of them has a second page here.
    "lista_autores": """
        SELECT id_libro, string_agg(nombre, ',' ORDER BY nombre) AS nombres
        FROM m_libro_autor JOIN m_autores USING (id_autor) GROUP BY id_libro""",
    "lista_categorias": """
        SELECT id_libro, string_agg(nombre || '|' || descripcion, ',' ORDER BY nombre, descripcion) AS nombres
        FROM m_libro_categoria JOIN m_categorias USING (id_categoria) GROUP BY id_libro""",
    "lista_libros": """
        SELECT id_prestamo, count(*) AS n, string_agg(titulo, ',' ORDER BY titulo) AS titulos
        FROM m_prestamo_libro JOIN m_libros USING (id_libro) GROUP BY id_prestamo""",
    # Parts of the results.
    "validas": """
        SELECT id_libro, id_prestamo, titulo, usuario FROM m_prestamo_libro
        SEMI JOIN (SELECT id_prestamo FROM m_prestamos SEMI JOIN m_usuarios USING (id_usuario)) USING (id_prestamo)
        JOIN (SELECT id_libro, titulo FROM m_libros) USING (id_libro)
        JOIN (SELECT id_prestamo, nombre AS usuario FROM m_prestamos JOIN m_usuarios USING (id_usuario)) USING (id_prestamo)""",
    "lineas": """
        SELECT * FROM validas JOIN (SELECT id_libro, count(*) AS veces_prestado FROM validas GROUP BY id_libro) USING (id_libro)""",
    "prestadas": """
        SELECT * FROM lineas QUALIFY row_number() OVER (ORDER BY veces_prestado DESC, id_libro, id_prestamo) <= 200""",
    "multas": f"""
        WITH tarde AS (
            SELECT id_usuario, id_prestamo, fecha_salida, CAST(date_diff('day', fecha_salida, {AS_OF}) - 7 AS INTEGER) AS dias_retraso
            FROM m_prestamos WHERE estado = 'Activo'),
        dueno AS (SELECT id_usuario, nombre AS usuario, correo FROM m_usuarios)
        SELECT usuario, correo, id_prestamo, fecha_salida, dias_retraso, 1000 * dias_retraso AS multa_total
        FROM tarde JOIN dueno USING (id_usuario) WHERE dias_retraso > 0
        QUALIFY rank() OVER (ORDER BY dias_retraso DESC, id_prestamo) <= 10""",
    "gate": """
        SELECT id_libro, cantidad AS disponible
        FROM (SELECT *, row_number() OVER (PARTITION BY id_libro ORDER BY id_sede) AS n FROM m_inventario) WHERE n = 1""",
    "devoluciones": """
        SELECT l_orderkey + CASE WHEN l_linenumber = 7 THEN 1000000000000 ELSE 0 END AS id_prestamo
        FROM lineitem WHERE l_returnflag = 'R'""",
    "solicitudes": """
        SELECT row_number() OVER (ORDER BY id_prestamo, id_libro) AS secuencia,
               CASE WHEN id_usuario % 59 = 0 THEN 'sin.' || correo ELSE correo END AS correo, estado, id_libro
        FROM m_prestamo_libro JOIN m_prestamos USING (id_prestamo) JOIN m_usuarios USING (id_usuario)""",
    "con_usuario": """
        SELECT s.*, u.id_usuario FROM solicitudes s
        LEFT JOIN (SELECT correo, min(id_usuario) AS id_usuario FROM m_usuarios GROUP BY correo) u USING (correo)""",
    "atendidas": """
        SELECT c.*, CASE WHEN id_usuario IS NULL THEN 'usuario_no_encontrado' WHEN disponible IS NULL THEN 'no_existe'
                         WHEN turno > greatest(disponible, 0) THEN 'sin_stock' ELSE 'aceptado' END AS resultado
        FROM (SELECT *, count(id_usuario) OVER (PARTITION BY id_libro ORDER BY secuencia) AS turno FROM con_usuario) c
        LEFT JOIN gate USING (id_libro)""",
    "opiniones": f"""
        SELECT e.event_id AS secuencia,
               CASE WHEN event_id % 61 = 0 THEN event_id + 1000000000000 ELSE user_id END AS id_usuario,
               event_id % ((SELECT count(*) FROM part) + 5) AS id_libro, event_type AS comentario,
               CASE WHEN event_id % 67 <> 0 THEN {RATING} END AS calificacion FROM events e""",
    "revisadas": """
        SELECT o.*, CASE WHEN calificacion < 1 OR calificacion > 5 THEN 'calificacion_invalida'
                         WHEN u.id_usuario IS NULL THEN 'usuario_no_encontrado'
                         WHEN l.id_libro IS NULL THEN 'libro_no_encontrado' ELSE 'aceptado' END AS resultado
        FROM opiniones o LEFT JOIN m_usuarios u ON o.id_usuario = u.id_usuario
        LEFT JOIN m_libros l ON o.id_libro = l.id_libro""",
}


def _with_tables(select: str) -> str:
    """``select`` preceded by the named tables it uses, in their order."""
    needed: set[str] = set()
    pending = [select]
    while pending:
        words = set(re.findall(r"\w+", pending.pop())) & TABLES.keys()
        for name in words - needed:
            needed.add(name)
            pending.append(TABLES[name])
    # MATERIALIZED: a named table used several times is computed once.
    named = ",\n".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in TABLES.items() if name in needed)
    return f"WITH {named}\n{select}" if named else select


# -- quality --------------------------------------------------------------------------------------

RULES = [
    # context, source, table, column, kind, action, message, condition of an error
    ("legacy", "lg_biblioteca", "Biblioteca_Data", "fecha_publicacion", "formato_fecha", "log_error",
     "La fecha no tiene formato válido", f"({_date('fecha_publicacion')}) IS NULL"),
    ("legacy", "lg_biblioteca", "Biblioteca_Data", "categoria_y_descripcion", "campo_combinado", "log_warning",
     "Campo combinado detectado (viola 1FN)", "contains(categoria_y_descripcion, '/')"),
    ("legacy", "lg_prestamos", "Prestamos_Crudos", "correo_usuario", "regex", "log_error",
     "Correo electrónico inválido", f"coalesce(NOT regexp_matches(correo_usuario, '{MAIL}'), true)"),
    ("legacy", "lg_prestamos", "Prestamos_Crudos", "libros_prestados", "multivalor", "log_warning",
     "Campo multivalor detectado", "contains(libros_prestados, ',')"),
    ("legacy", "lg_resenas", "Reseñas_Usuarios", "calificacion", "rango_numerico", "log_error",
     "Calificación fuera de rango", f"coalesce(NOT ({_int('calificacion')}) BETWEEN 1 AND 5, true)"),
    ("normalizada", "e_libros", "Libros", "fecha_publicacion", "formato_fecha", "log_error",
     "Fecha inválida en normalizada", "fecha_publicacion IS NULL"),
    ("normalizada", "e_usuarios", "Usuarios", "correo", "regex", "log_error",
     "Correo inválido en normalizada", f"coalesce(NOT regexp_matches(correo, '{MAIL}'), true)"),
    ("normalizada", "e_resenas", "Reseñas", "calificacion", "rango_numerico", "log_error",
     "Calificación fuera de rango en normalizada", "coalesce(NOT calificacion BETWEEN 1 AND 5, true)"),
]


def _report(context: str, kind: str | None = None) -> str:
    lines, order = [], 0
    for ctx, source, table, column, rule, action, message, error in RULES:
        if ctx != context or kind not in (None, rule):
            continue
        order += 1
        lines.append(
            f"SELECT CAST({order} AS INTEGER) AS orden, '{ctx}' AS contexto, '{table}' AS tabla, '{column}' AS columna, "
            f"'{rule}' AS tipo, '{action}' AS accion, '{message}' AS mensaje, true AS conocida, count(*) AS filas, "
            f"count(*) FILTER (WHERE {error}) AS errores FROM {source}"
        )
    return "\nUNION ALL ".join(lines)


def _kind(kind: str) -> str:
    return f"SELECT tabla, columna, tipo, filas, errores FROM ({_report('legacy', kind)})"


def _rejects() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS tabla, '{column}' AS columna, '{rule}' AS tipo, {column} AS valor FROM {source} WHERE {error}"
        for ctx, source, table, column, rule, _, _, error in RULES
        if ctx == "legacy"
    )


COMPARE = f"""
    SELECT tipo, CAST(coalesce(sum(errores) FILTER (WHERE contexto = 'legacy'), 0) AS BIGINT) AS errores_legacy,
           CAST(coalesce(sum(errores) FILTER (WHERE contexto = 'normalizada'), 0) AS BIGINT) AS errores_normalizada
    FROM ({_report('legacy')} UNION ALL {_report('normalizada')}) GROUP BY tipo"""

LOG_LINES = f"""
    SELECT orden, '[VALIDACION] Tabla: ' || tabla || ' | Columna: ' || columna || ' | Tipo: ' || tipo || ' | Errores: '
           || CAST(errores AS VARCHAR) AS linea FROM ({_report('legacy')})"""

QUARANTINE = f"""
    SELECT 'biblioteca_data' AS tabla, 'fecha_publicacion' AS columna, fecha_publicacion AS valor, count(*) AS filas
    FROM lg_biblioteca WHERE fecha_publicacion IS NOT NULL AND ({_date('fecha_publicacion')}) IS NULL GROUP BY ALL
    UNION ALL
    SELECT 'resenas_usuarios', 'calificacion', calificacion, count(*)
    FROM lg_resenas WHERE calificacion IS NOT NULL AND ({_int('calificacion')}) IS NULL GROUP BY ALL"""

# -- checks ---------------------------------------------------------------------------------------

KEYS = {
    "editoriales": "id_editorial",
    "libros": "id_libro",
    "autores": "id_autor",
    "libro_autor": "id_libro,id_autor",
    "categorias": "id_categoria",
    "libro_categoria": "id_libro,id_categoria",
    "usuarios": "id_usuario",
    "prestamos": "id_prestamo",
    "prestamo_libro": "id_prestamo,id_libro",
    "resenas": "id_resena",
    "sedes": "id_sede",
    "inventario": "id_sede,id_libro",
}

REFERENCES = [
    ("libros", "id_editorial", "editoriales"),
    ("libro_autor", "id_libro", "libros"),
    ("libro_autor", "id_autor", "autores"),
    ("libro_categoria", "id_libro", "libros"),
    ("libro_categoria", "id_categoria", "categorias"),
    ("prestamos", "id_usuario", "usuarios"),
    ("prestamo_libro", "id_prestamo", "prestamos"),
    ("prestamo_libro", "id_libro", "libros"),
    ("inventario", "id_sede", "sedes"),
    ("inventario", "id_libro", "libros"),
    ("resenas", "id_usuario", "usuarios"),
    ("resenas", "id_libro", "libros"),
]

LENGTHS = [
    ("editoriales", "nombre", 255),
    ("libros", "titulo", 255),
    ("autores", "nombre", 255),
    ("categorias", "nombre", 100),
    ("usuarios", "nombre", 255),
    ("usuarios", "correo", 255),
    ("prestamos", "estado", 20),
    ("sedes", "nombre", 100),
    ("sedes", "ubicacion", 255),
]


def _primary_keys(prefix: str) -> str:
    lines = []
    for table, key in KEYS.items():
        missing = " OR ".join(f"{c} IS NULL" for c in key.split(","))
        lines.append(
            f"SELECT '{table}' AS tabla, '{key}' AS clave, CAST(coalesce(sum(n), 0) AS BIGINT) AS filas, "
            f"CAST(coalesce(sum(n) FILTER (WHERE {missing}), 0) AS BIGINT) AS nulos, "
            f"count(*) FILTER (WHERE n > 1 AND NOT ({missing})) AS duplicados "
            f"FROM (SELECT {key}, count(*) AS n FROM {prefix}{table} GROUP BY {key})"
        )
    return "\nUNION ALL ".join(lines)


def _foreign_keys(prefix: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{child}' AS tabla, '{column}' AS columna, '{parent}' AS padre, count({column}) AS filas, "
        f"count(*) FILTER (WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {column} FROM {prefix}{parent})) "
        f"AS huerfanas FROM {prefix}{child}"
        for child, column, parent in REFERENCES
    )


def _lengths(prefix: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS tabla, '{column}' AS columna, CAST({limit} AS INTEGER) AS limite, "
        f"CAST(coalesce(max(length({column})), 0) AS INTEGER) AS maximo, "
        f"count(*) FILTER (WHERE length({column}) > {limit}) AS excedidas FROM {prefix}{table}"
        for table, column, limit in LENGTHS
    )


# -- documents ------------------------------------------------------------------------------------

BOOK_DOCUMENTS = """
    SELECT l.id_libro AS _id, CAST(0 AS INTEGER) AS parte, l.titulo, CAST(l.fecha_publicacion AS TIMESTAMP) AS fecha,
           e.nombre AS editorial, coalesce(a.nombres, '') AS autores, coalesce(c.nombres, '') AS categorias
    FROM m_libros l JOIN m_editoriales e USING (id_editorial)
    LEFT JOIN lista_autores a ON l.id_libro = a.id_libro LEFT JOIN lista_categorias c ON l.id_libro = c.id_libro"""

LOAN_DOCUMENTS = """
    SELECT p.id_prestamo AS _id, CAST(0 AS INTEGER) AS parte, CAST(p.fecha_salida AS TIMESTAMP) AS fecha, p.estado,
           u.nombre, u.correo, CAST(coalesce(b.n, 0) AS INTEGER) AS n_libros, coalesce(b.titulos, '') AS libros
    FROM m_prestamos p JOIN m_usuarios u USING (id_usuario) LEFT JOIN lista_libros b ON p.id_prestamo = b.id_prestamo"""

INVENTORY_DOCUMENTS = """
    SELECT i.cantidad AS stock, s.nombre AS sede, s.ubicacion, l.id_libro, l.titulo
    FROM m_inventario i JOIN m_sedes s ON i.id_sede = s.id_sede JOIN m_libros l ON i.id_libro = l.id_libro"""

DOCUMENT_COUNTS = """
    SELECT 'libros' AS coleccion, count(*) AS documentos FROM m_libros JOIN m_editoriales USING (id_editorial)
    UNION ALL SELECT 'usuarios', count(*) FROM m_usuarios
    UNION ALL SELECT 'prestamos', count(*) FROM m_prestamos JOIN m_usuarios USING (id_usuario)
    UNION ALL SELECT 'inventario', count(*) FROM m_inventario JOIN m_sedes USING (id_sede) JOIN m_libros USING (id_libro)"""

# -- movements ------------------------------------------------------------------------------------

GATE = """
    SELECT secuencia, id_libro, turno, disponible,
           CASE WHEN disponible IS NULL THEN 'no_existe' WHEN turno > greatest(disponible, 0) THEN 'sin_stock'
                ELSE 'aceptado' END AS resultado
    FROM (SELECT id_prestamo AS secuencia, id_libro,
                 row_number() OVER (PARTITION BY id_libro ORDER BY id_prestamo) AS turno FROM m_prestamo_libro)
    LEFT JOIN gate USING (id_libro)"""

# The last sequence a book's stock serves, by position in the sorted list of its requests.
THRESHOLD = """
    SELECT id_prestamo AS secuencia, l.id_libro, disponible,
           CASE WHEN disponible IS NULL THEN 'no_existe' WHEN disponible <= 0 OR coalesce(id_prestamo > ultima, false) THEN 'sin_stock'
                ELSE 'aceptado' END AS resultado
    FROM m_prestamo_libro l LEFT JOIN gate USING (id_libro)
    LEFT JOIN (SELECT id_libro, list_sort(list(id_prestamo))[disponible] AS ultima
               FROM m_prestamo_libro JOIN gate USING (id_libro) WHERE disponible > 0 GROUP BY id_libro, disponible) u USING (id_libro)"""

STOCK_AFTER = f"""
    SELECT id_sede, id_libro, CAST(cantidad - coalesce(n, 0) AS BIGINT) AS cantidad
    FROM m_inventario LEFT JOIN (SELECT id_libro, count(*) AS n FROM ({GATE}) WHERE resultado = 'aceptado' GROUP BY id_libro)
    USING (id_libro)"""

REGISTER_LOANS = f"""
    SELECT secuencia, CASE WHEN resultado = 'aceptado' THEN
               (SELECT max(id_prestamo) FROM m_prestamos) + CAST(count(*) FILTER (WHERE resultado = 'aceptado')
               OVER (ORDER BY secuencia) AS BIGINT) END AS id_prestamo, id_usuario, id_libro,
           CASE WHEN resultado = 'aceptado' THEN {AS_OF} END AS fecha_salida, estado, resultado
    FROM atendidas"""

RETURN_LOANS = """
    SELECT id_prestamo, id_usuario, fecha_salida,
           CASE WHEN id_prestamo IN (SELECT id_prestamo FROM devoluciones) THEN 'Devuelto' ELSE estado END AS estado
    FROM m_prestamos"""

UNKNOWN_RETURNS = """
    SELECT id_prestamo, count(*) AS solicitudes FROM devoluciones d
    WHERE NOT EXISTS (SELECT 1 FROM m_prestamos p WHERE p.id_prestamo = d.id_prestamo) GROUP BY id_prestamo"""

REGISTER_REVIEWS = """
    SELECT secuencia, CASE WHEN resultado = 'aceptado' THEN (SELECT max(id_resena) FROM m_resenas)
               + CAST(count(*) FILTER (WHERE resultado = 'aceptado') OVER (ORDER BY secuencia) AS BIGINT) END AS id_resena,
           id_usuario, id_libro, comentario, calificacion, resultado FROM revisadas"""

FINE_BY_LOAN = f"""
    SELECT d.id_prestamo,
           CASE WHEN fecha_salida IS NOT NULL THEN CAST(greatest({AS_OF} - fecha_salida - 7, 0) * 1000 AS INTEGER) END AS multa,
           fecha_salida IS NOT NULL AS existe
    FROM (SELECT id_prestamo FROM m_prestamos UNION SELECT id_prestamo FROM devoluciones) d
    LEFT JOIN m_prestamos USING (id_prestamo)"""

FINES_TEXT = """
    SELECT id_prestamo, format('{:<25} {:<30} {:<13} {:<14} {:<14} {:,}', usuario, correo, id_prestamo,
           CAST(fecha_salida AS VARCHAR), dias_retraso, multa_total) AS linea FROM multas"""

BORROWED_TEXT = """
    SELECT id_libro, id_prestamo, format('{:<45} {:<25} {}', titulo, usuario, veces_prestado) AS linea FROM prestadas"""

AUDIT_LOG = f"""
    SELECT row_number() OVER (ORDER BY id_prestamo) AS id_log, id_prestamo, nombre AS usuario, fecha_salida,
           {RUN_TIME} AS fecha_log
    FROM m_prestamos JOIN m_usuarios USING (id_usuario) WHERE estado = 'Activo'"""

LOAD_CHECK = f"""
    SELECT 'clave primaria' AS restriccion, tabla, clave AS columnas, nulos + duplicados AS infracciones
    FROM ({_primary_keys('m_')}) WHERE nulos + duplicados > 0
    UNION ALL SELECT 'clave foranea', tabla, columna, huerfanas FROM ({_foreign_keys('m_')}) WHERE huerfanas > 0
    UNION ALL SELECT 'longitud', tabla, columna, excedidas FROM ({_lengths('m_')}) WHERE excedidas > 0"""

FANOUT = "\nUNION ALL ".join(
    f"SELECT '{step}' AS paso, (SELECT count(*) FROM {raw}) AS filas_crudas, count(*) AS filas FROM e_{step}"
    for step, raw in (
        ("libros", "lg_biblioteca"),
        ("libro_autor", "lg_biblioteca"),
        ("libro_categoria", "lg_biblioteca"),
        ("prestamos", "lg_prestamos"),
        ("resenas", "lg_resenas"),
        ("inventario", "lg_inventario"),
    )
)

# -- registry -------------------------------------------------------------------------------------

TABLE_COLUMNS = {
    "editoriales": "id_editorial, nombre",
    "libros": "id_libro, titulo, fecha_publicacion, id_editorial",
    "autores": "id_autor, nombre",
    "libro_autor": "id_libro, id_autor",
    "categorias": "id_categoria, nombre, descripcion",
    "libro_categoria": "id_libro, id_categoria",
    "usuarios": "id_usuario, nombre, correo",
    "prestamos": "id_prestamo, id_usuario, fecha_salida, estado",
    "prestamo_libro": "id_prestamo, id_libro",
    "resenas": "id_resena, id_usuario, id_libro, comentario, calificacion",
    "sedes": "id_sede, nombre, ubicacion",
    "inventario": "id_sede, id_libro, cantidad",
}

SELECTS: dict[str, str] = {
    "legacy_biblioteca_data": "SELECT * FROM lg_biblioteca",
    "legacy_prestamos_crudos": "SELECT * FROM lg_prestamos",
    "legacy_inventario_sedes": "SELECT * FROM lg_inventario",
    "legacy_resenas_usuarios": "SELECT * FROM lg_resenas",
    **{f"dq_{k}": _kind(k) for k in ("regex", "rango_numerico", "multivalor", "campo_combinado", "formato_fecha")},
    "dq_report_legacy": _report("legacy"),
    "dq_report_normalizada": _report("normalizada"),
    "dq_observado": f"""SELECT tabla, columna, tipo, filas, errores, filas AS filas_contadas, errores AS errores_contados
        FROM ({_report('normalizada')})""",
    "dq_compare_contexts": COMPARE,
    "dq_log_lines": LOG_LINES,
    "dq_rejects": _rejects(),
    **{f"elt_{t}": f"SELECT {c} FROM e_{t}" for t, c in TABLE_COLUMNS.items()},
    **{f"elt_estricto_{t}": f"SELECT {c} FROM s_{t}" for t, c in TABLE_COLUMNS.items()},
    "elt_prestamo_libro": DRAWN_PAIRS,
    "elt_listas_prestamo_libro": "SELECT id_prestamo, id_libro FROM e_prestamo_libro",
    "elt_enlaces_azar": RANDOM_LINKS,
    "elt_fanout": FANOUT,
    "elt_cuarentena": QUARANTINE,
    "dq_tipo_desconocido": """
        SELECT 'Inventario_Sedes' AS tabla, 'sede_nombre' AS columna, 'fonetica' AS tipo, false AS conocida,
               count(*) AS filas, CAST(0 AS BIGINT) AS errores FROM lg_inventario""",
    "chk_carga": LOAD_CHECK,
    "chk_pk": _primary_keys("e_"),
    "chk_fk": _foreign_keys("e_"),
    "chk_varchar_len": _lengths("e_"),
    "chk_pk_biblioteca": _primary_keys("m_"),
    "chk_fk_biblioteca": _foreign_keys("m_"),
    "doc_libros": BOOK_DOCUMENTS,
    "doc_usuarios": "SELECT id_usuario AS _id, nombre, correo FROM m_usuarios",
    "doc_prestamos": LOAN_DOCUMENTS,
    "doc_inventario": INVENTORY_DOCUMENTS,
    "doc_counts": DOCUMENT_COUNTS,
    "rpt_libros_mas_prestados": "SELECT id_libro, id_prestamo, titulo, usuario, veces_prestado FROM prestadas",
    "rpt_vista_consulta": "SELECT id_libro, id_prestamo, titulo, usuario, veces_prestado FROM prestadas",
    "rpt_vista_prestados": "SELECT titulo, usuario, veces_prestado, id_libro, id_prestamo FROM lineas",
    "rpt_prestados_texto": BORROWED_TEXT,
    "rpt_top_multas": "SELECT * FROM multas",
    "rpt_multas_texto": FINES_TEXT,
    "fn_calcular_multa": FINE_BY_LOAN,
    "fn_libros_por_categoria": """
        SELECT titulo, c.nombre AS categoria FROM m_libros JOIN m_libro_categoria USING (id_libro)
        JOIN m_categorias c USING (id_categoria) WHERE c.nombre = 'NATION_3'""",
    "op_control_inventario": GATE,
    "op_control_umbral": THRESHOLD,
    "op_stock_after": STOCK_AFTER,
    "op_registrar_prestamo": REGISTER_LOANS,
    "op_devolver_libro": RETURN_LOANS,
    "op_devolver_rechazos": UNKNOWN_RETURNS,
    "op_registrar_resena": REGISTER_REVIEWS,
    "log_prestamos": AUDIT_LOG,
}


def oracles() -> dict[str, str]:
    return {name: _with_tables(select) for name, select in SELECTS.items()}
