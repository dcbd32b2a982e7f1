"""Declared tables: columns, keys, references and length limits.

Table and column names keep the words of the data model, in ASCII and lower case. Surrogate keys
are BIGINT so that numbering does not stop at 2^31 rows.
"""

from __future__ import annotations

import unicodedata
from typing import NamedTuple

# The declared legacy model.
LEGACY = {
    "biblioteca_data": "id_registro BIGINT, titulo_libro STRING, autor_nombre STRING, categoria_y_descripcion STRING, "
    "editorial_info STRING, fecha_publicacion STRING",
    "prestamos_crudos": "id_prestamo BIGINT, nombre_usuario STRING, correo_usuario STRING, libros_prestados STRING, "
    "fecha_salida DATE, estado_prestamo STRING",
    "inventario_sedes": "sede_nombre STRING, ubicacion_sede STRING, libro_asociado STRING, cantidad_total BIGINT",
    "resenas_usuarios": "usuario_id BIGINT, libro_titulo STRING, comentario STRING, calificacion STRING",
}

# The declared normalised model.
NORMALISED = {
    "editoriales": "id_editorial BIGINT, nombre STRING",
    "libros": "id_libro BIGINT, titulo STRING, fecha_publicacion DATE, id_editorial BIGINT",
    "autores": "id_autor BIGINT, nombre STRING",
    "libro_autor": "id_libro BIGINT, id_autor BIGINT",
    "categorias": "id_categoria BIGINT, nombre STRING, descripcion STRING",
    "libro_categoria": "id_libro BIGINT, id_categoria BIGINT",
    "usuarios": "id_usuario BIGINT, nombre STRING, correo STRING",
    "prestamos": "id_prestamo BIGINT, id_usuario BIGINT, fecha_salida DATE, estado STRING",
    "prestamo_libro": "id_prestamo BIGINT, id_libro BIGINT",
    "sedes": "id_sede BIGINT, nombre STRING, ubicacion STRING",
    "inventario": "id_sede BIGINT, id_libro BIGINT, cantidad BIGINT",
    "resenas": "id_resena BIGINT, id_usuario BIGINT, id_libro BIGINT, comentario STRING, calificacion INT",
}

AUDIT_LOG = "id_log BIGINT, id_prestamo BIGINT, usuario STRING, fecha_salida DATE, fecha_log TIMESTAMP_NTZ"

# Primary keys.
PRIMARY_KEYS = {
    "editoriales": ("id_editorial",),
    "libros": ("id_libro",),
    "autores": ("id_autor",),
    "libro_autor": ("id_libro", "id_autor"),
    "categorias": ("id_categoria",),
    "libro_categoria": ("id_libro", "id_categoria"),
    "usuarios": ("id_usuario",),
    "prestamos": ("id_prestamo",),
    "prestamo_libro": ("id_prestamo", "id_libro"),
    "sedes": ("id_sede",),
    "inventario": ("id_sede", "id_libro"),
    "resenas": ("id_resena",),
    "biblioteca_data": ("id_registro",),
    "log_prestamos": ("id_log",),
}


class Reference(NamedTuple):
    child: str
    column: str
    parent: str


# Foreign keys; the parent column has the same name.
FOREIGN_KEYS = (
    Reference("libros", "id_editorial", "editoriales"),
    Reference("libro_autor", "id_libro", "libros"),
    Reference("libro_autor", "id_autor", "autores"),
    Reference("libro_categoria", "id_libro", "libros"),
    Reference("libro_categoria", "id_categoria", "categorias"),
    Reference("prestamos", "id_usuario", "usuarios"),
    Reference("prestamo_libro", "id_prestamo", "prestamos"),
    Reference("prestamo_libro", "id_libro", "libros"),
    Reference("inventario", "id_sede", "sedes"),
    Reference("inventario", "id_libro", "libros"),
    Reference("resenas", "id_usuario", "usuarios"),
    Reference("resenas", "id_libro", "libros"),
)

# Length limits of text columns.
MAX_LENGTHS = {
    ("editoriales", "nombre"): 255,
    ("libros", "titulo"): 255,
    ("autores", "nombre"): 255,
    ("categorias", "nombre"): 100,
    ("usuarios", "nombre"): 255,
    ("usuarios", "correo"): 255,
    ("prestamos", "estado"): 20,
    ("sedes", "nombre"): 100,
    ("sedes", "ubicacion"): 255,
}


def canonical(name: str) -> str:
    """ASCII lower-case form of a table name: ``Reseñas_Usuarios`` is ``resenas_usuarios``."""
    return unicodedata.normalize("NFD", name).encode("ascii", "ignore").decode().lower()


def columns(table: str) -> list[str]:
    declared = NORMALISED.get(table) or LEGACY[table]
    return [part.split()[0] for part in declared.split(", ")]
