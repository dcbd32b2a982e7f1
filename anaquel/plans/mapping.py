"""How tables become document collections: the fixed default mapping, and reading one from a file.

Per table: the collection, the renamed fields, and what is embedded. ``local_key`` embeds the one
row the key refers to; ``via`` embeds the list of rows linked through a bridge table.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

# Collections, fields and embedded documents.
DEFAULT_MAPPING: Mapping[str, dict] = {
    "Libros": {
        "collection": "libros",
        "fields": {"id_libro": "_id", "titulo": "titulo", "fecha_publicacion": "fecha"},
        "embebidos": {
            "editorial": {"source": "Editoriales", "local_key": "id_editorial", "fields": {"nombre": "nombre"}},
            "autores": {"source": "Autores", "via": "Libro_Autor", "fields": {"nombre": "nombre"}},
            "categorias": {
                "source": "Categorias",
                "via": "Libro_Categoria",
                "fields": {"nombre": "nombre", "descripcion": "descripcion"},
            },
        },
    },
    "Usuarios": {
        "collection": "usuarios",
        "fields": {"id_usuario": "_id", "nombre": "nombre", "correo": "correo"},
    },
    "Prestamos": {
        "collection": "prestamos",
        "fields": {"id_prestamo": "_id", "fecha_salida": "fecha", "estado": "estado"},
        "embebidos": {
            "usuario": {
                "source": "Usuarios",
                "local_key": "id_usuario",
                "fields": {"nombre": "nombre", "correo": "correo"},
            },
            "libros": {"source": "Libros", "via": "Prestamo_Libro", "fields": {"titulo": "titulo"}},
        },
    },
    "Inventario": {
        "collection": "inventario",
        "fields": {"cantidad": "stock"},
        "embebidos": {
            "sede": {
                "source": "Sedes",
                "local_key": "id_sede",
                "fields": {"nombre": "nombre", "ubicacion": "ubicacion"},
            },
            "libro": {
                "source": "Libros",
                "local_key": "id_libro",
                "fields": {"id_libro": "_id", "titulo": "titulo"},
            },
        },
    },
}


def load_mapping(path: str) -> Mapping[str, dict]:
    with open(path, encoding="utf-8") as file:
        return json.load(file)
