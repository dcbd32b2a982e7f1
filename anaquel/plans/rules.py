"""The quality rules: their fixed defaults, and reading them from a file."""

from __future__ import annotations

import json
from collections.abc import Mapping

RuleSet = Mapping[str, list[dict]]

# The e-mail pattern, and the rules in their order.
MAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"

DEFAULT_RULES: RuleSet = {
    "Biblioteca_Data": [
        {
            "columna": "fecha_publicacion",
            "tipo_validacion": "formato_fecha",
            "formato": "YYYY-MM-DD",
            "contexto": "legacy",
            "accion": "log_error",
            "mensaje": "La fecha no tiene formato válido",
        },
        {
            "columna": "categoria_y_descripcion",
            "tipo_validacion": "campo_combinado",
            "separador": "/",
            "contexto": "legacy",
            "accion": "log_warning",
            "mensaje": "Campo combinado detectado (viola 1FN)",
        },
    ],
    "Prestamos_Crudos": [
        {
            "columna": "correo_usuario",
            "tipo_validacion": "regex",
            "patron": MAIL,
            "contexto": "legacy",
            "accion": "log_error",
            "mensaje": "Correo electrónico inválido",
        },
        {
            "columna": "libros_prestados",
            "tipo_validacion": "multivalor",
            "separador": ",",
            "contexto": "legacy",
            "accion": "log_warning",
            "mensaje": "Campo multivalor detectado",
        },
    ],
    "Reseñas_Usuarios": [
        {
            "columna": "calificacion",
            "tipo_validacion": "rango_numerico",
            "min": 1,
            "max": 5,
            "contexto": "legacy",
            "accion": "log_error",
            "mensaje": "Calificación fuera de rango",
        },
    ],
    "Libros": [
        {
            "columna": "fecha_publicacion",
            "tipo_validacion": "formato_fecha",
            "contexto": "normalizada",
            "accion": "log_error",
            "mensaje": "Fecha inválida en normalizada",
        },
    ],
    "Usuarios": [
        {
            "columna": "correo",
            "tipo_validacion": "regex",
            "patron": MAIL,
            "contexto": "normalizada",
            "accion": "log_error",
            "mensaje": "Correo inválido en normalizada",
        },
    ],
    "Reseñas": [
        {
            "columna": "calificacion",
            "tipo_validacion": "rango_numerico",
            "min": 1,
            "max": 5,
            "contexto": "normalizada",
            "accion": "log_error",
            "mensaje": "Calificación fuera de rango en normalizada",
        },
    ],
}


def load_rules(path: str) -> RuleSet:
    """Rules from a JSON file with the tables under ``reglas_validacion``."""
    with open(path, encoding="utf-8") as file:
        return json.load(file)["reglas_validacion"]
