"""The raw layer derived from a TPC-H-like set of Parquet tables.

Every raw table the engine reads has a stand-in here, dirty rows included, so
that the whole chain can run on any scale of those tables. Each method returns a
lazy frame; columns that a query does not use never leave the scan.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from retaloom.functions.dates import period_key
from retaloom.functions.numbers import MONEY, money, rounded_money
from retaloom.sources.places import DEPARTMENTS

PANEL_WIDTH = 25  # parts per inventory SKU: keeps the monthly panel equally dense at any scale


def _code(prefix: str, key: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), width, "0"))


class StandIns:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def read(self, name: str, tag: bool = False) -> DataFrame:
        return self.ventas(True) if tag and name == "ventas" else getattr(self, name)()

    def lines(self, tag: bool = False) -> DataFrame:
        """Lines with exact money, and with a deterministic tag per stored row if asked."""
        gross, off = money("l_extendedprice"), money("l_discount")
        row = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("_tag")
        return self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_tax",
            "l_returnflag", "l_linestatus",
            F.to_date("l_shipdate").alias("dia"),
            F.col("l_quantity").cast("bigint").alias("uds"),
            rounded_money(F.col("l_extendedprice") / F.col("l_quantity")).alias("precio"),
            gross.alias("bruto"),
            off.alias("dcto"),
            F.round(gross * (F.lit(1) - off), 2).cast(MONEY).alias("neto"),
            F.round(gross * F.lit(Decimal("0.70")), 2).cast(MONEY).alias("costo"),
            F.round(gross * off, 2).cast(MONEY).alias("promo"),
            *([row] if tag else []),
        )

    # -- transactional sources ------------------------------------------------

    def ventas(self, tag: bool = False) -> DataFrame:
        dup = F.col("l_linestatus").eqNullSafe("F")  # null-safe: the rule reaches the scan
        heads = (
            self.table("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
            .join(self.table("customer").select("c_custkey", "c_nationkey"),
                  F.col("o_custkey") == F.col("c_custkey"))
        )
        sellers = self.table("supplier").select("s_suppkey", "s_nationkey")
        return (
            self.lines(tag)
            .join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
            .select(
                F.concat(
                    F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber"),
                    F.when(dup, "_DUP").otherwise(""),
                ).alias("id_linea_venta"),
                F.col("l_orderkey").alias("num_factura"),
                F.when(dup, "DUPLICADO").otherwise("ACTIVO").alias("estado_linea"),
                F.col("dia").alias("fecha_emision"),
                F.col("o_custkey").alias("id_cliente"),
                F.col("l_partkey").alias("id_producto"),
                F.substring("o_orderpriority", 1, 1).cast("bigint").alias("id_canal"),
                F.col("c_nationkey").cast("bigint").alias("id_geografia"),
                F.col("l_suppkey").alias("id_vendedor"),
                F.col("s_nationkey").cast("bigint").alias("id_almacen"),
                F.col("uds").alias("cantidad_vendida"),
                F.col("precio").alias("precio_unitario_soles"),
                F.round(F.col("precio") * F.lit(Decimal("1.10")), 2).cast(MONEY)
                .alias("precio_lista_soles"),
                F.col("bruto").alias("monto_bruto_soles"),
                (F.col("dcto") * 100).cast(MONEY).alias("descuento_pct"),
                F.col("neto").alias("ventas_netas_soles"),
                F.col("costo").alias("costo_ventas_soles"),
                F.col("promo").alias("inversion_promocional_soles"),
                F.trunc("dia", "month").alias("fecha_carga"),
                *(["_tag"] if tag else []),
            )
        )

    def pedidos(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("id_pedido"),
            F.to_date("o_orderdate").alias("fecha_pedido"),
            F.col("o_custkey").alias("id_cliente"),
            F.col("o_orderstatus").alias("estado_pedido"),
            money("o_totalprice").alias("monto_pedido_soles"),
            F.trunc("o_orderdate", "month").alias("fecha_carga"),
        )

    def devoluciones(self) -> DataFrame:
        approved = F.col("l_linenumber") <= 4
        return self.lines().where(F.col("l_returnflag") == "R").select(
            F.col("l_orderkey").alias("num_factura_origen"),
            F.col("l_partkey").alias("id_producto"),
            F.col("uds").alias("cantidad_devuelta"),
            F.col("neto").alias("monto_devolucion_soles"),
            F.col("dia").alias("fecha_solicitud_dev"),
            F.when(approved, "APROBADA").when(F.col("l_linenumber") <= 6, "PENDIENTE")
            .otherwise("RECHAZADA").alias("estado_devolucion"),
            F.when(approved, F.concat(F.lit("NC-"), F.col("l_orderkey"))).alias("num_nota_credito"),
            F.when(approved, F.date_add("dia", 10)).alias("fecha_aprobacion_dev"),
            F.trunc("dia", "month").alias("fecha_carga"),
        )

    def fill_rate(self) -> DataFrame:
        full = F.col("l_returnflag") != "R"
        on_time = F.col("dcto") < F.lit(Decimal("0.05"))
        carrier = F.when(F.col("dcto") == F.lit(Decimal("0.10")), "").when(
            F.col("dcto") != F.lit(Decimal("0.02")),
            F.concat(F.lit("T-"), (F.col("l_suppkey") % 7).cast("string")),
        )
        reason = F.when(~full & (F.col("l_linenumber") > 1),
                        F.when(F.col("l_linenumber") == 2, "").otherwise("ROTURA"))
        return self.lines().select(
            F.concat(F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("id_despacho"),
            F.col("dia").alias("fecha_despacho"),
            carrier.alias("transportista"),
            reason.alias("motivo_rechazo"),
            on_time.cast("int").alias("flag_on_time"),
            full.cast("int").alias("flag_in_full"),
            ((on_time & full) | ((F.col("l_linenumber") == 7) & full)).cast("int")
            .alias("flag_otif"),
            F.when(full, 0).otherwise(F.col("uds")).alias("cantidad_rechazada_uds"),
            F.trunc("dia", "month").alias("fecha_carga"),
        )

    def inventario(self) -> DataFrame:
        sellers = self.table("supplier").select("s_suppkey", "s_nationkey")
        cells = (
            self.lines().join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy(
                F.trunc("dia", "month").alias("fecha_snapshot"),
                F.expr(f"l_partkey div {PANEL_WIDTH}").alias("id_producto"),
                F.col("s_nationkey").cast("bigint").alias("id_almacen"),
            )
            .agg(F.sum("uds").alias("u"), F.count(F.lit(1)).alias("stock_reservado"))
            .withColumn("stock_disponible", F.col("u") - 20)
            .withColumn("demanda_diaria_prom", rounded_money(F.col("u") / 30))
        )
        negative = F.col("stock_disponible") < 0
        return cells.select(
            F.concat_ws("-", F.date_format("fecha_snapshot", "yyyyMM"), "id_producto", "id_almacen")
            .alias("id_snapshot_inv"),
            "fecha_snapshot", "id_producto", "id_almacen", "stock_disponible", "stock_reservado",
            "demanda_diaria_prom",
            (F.col("stock_disponible") <= 0).cast("int").alias("flag_quiebre_stock"),
            F.round(
                (F.col("stock_disponible") / F.nullif("demanda_diaria_prom", F.lit(0)))
                .cast("double").cast("decimal(38,10)"), 1,
            ).cast("decimal(18,1)").alias("dias_cobertura_calc"),
            F.when(negative, F.when(F.col("id_almacen") % 11 != 0,
                                    F.when(F.col("id_producto") % 9 == 0, "N").otherwise("S")))
            .otherwise("N").alias("flag_ajuste_pendiente"),
            F.when(negative, "AJUSTE").alias("motivo_ajuste"),
            F.col("fecha_snapshot").alias("fecha_carga"),
        )

    def metas(self) -> DataFrame:
        """Three target versions per channel and month; June and December stay unapproved."""
        heads = self.table("orders").select("o_orderkey", "o_orderpriority")
        base = (
            self.lines().join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy(
                period_key(F.col("dia")).alias("periodo"),
                F.substring("o_orderpriority", 1, 1).cast("bigint").alias("id_canal"),
            )
            .agg(F.sum("neto").alias("neto"), F.sum("uds").alias("uds"))
            .withColumn("version_meta", F.explode(F.array(F.lit("V1"), F.lit("V2"), F.lit("V3"))))
        )
        month = (F.col("periodo") % 100).cast("int")
        approved = (F.col("version_meta") == "V3") & (month % 6 != 0)
        share = lambda x: F.round(F.col("neto") * F.lit(Decimal(x)), 2).cast(MONEY)
        fixed = lambda x: F.lit(Decimal(x)).cast(MONEY)
        return base.select(
            F.concat(F.lit("META-"), F.col("version_meta"), F.lit("-"), F.col("periodo"),
                     F.col("id_canal")).alias("id_meta_raw"),
            "periodo",
            F.floor(F.col("periodo") / 100).cast("int").alias("anio"),
            month.alias("mes"),
            "id_canal",
            share("0.52").alias("meta_ventas_netas_soles"),
            share("0.15").alias("meta_margen_bruto_soles"),
            fixed("26.50").alias("meta_margen_bruto_pct"),
            F.expr("uds div 2").alias("meta_cantidad_vendida"),
            (fixed("60000.00") + F.col("id_canal") * 1000).cast(MONEY)
            .alias("meta_ticket_promedio_soles"),
            fixed("1.20").alias("meta_frecuencia_compra"),
            fixed("400.00").alias("meta_roi_promocional_pct"),
            fixed("30.00").alias("meta_tasa_devolucion_pct"),
            "version_meta",
            approved.cast("int").alias("es_version_aprobada"),
            F.when(approved, "GERENCIA").alias("aprobado_por"),
            F.when(approved, F.lit("2000-01-01")).alias("fecha_aprobacion"),
            F.make_date(F.floor(F.col("periodo") / 100).cast("int"), month, F.lit(1))
            .alias("fecha_carga"),
        )

    def metas_operativas(self) -> DataFrame:
        sellers = self.table("supplier").select("s_suppkey", "s_nationkey")
        base = (
            self.lines().select("l_suppkey", "dia")
            .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
            .select(period_key(F.col("dia")).alias("periodo"),
                    F.col("s_nationkey").cast("bigint").alias("id_almacen"))
            .distinct()
        )
        month = (F.col("periodo") % 100).cast("int")
        fixed = lambda x: F.lit(Decimal(x)).cast(MONEY)
        return base.select(
            "periodo",
            F.floor(F.col("periodo") / 100).cast("int").alias("anio"),
            month.alias("mes"),
            "id_almacen",
            (fixed("5.00") + F.col("id_almacen") % 4).cast(MONEY).alias("meta_quiebre_pct"),
            (fixed("10.00") + month).cast(MONEY).alias("meta_dias_cobertura"),
            fixed("90.00").alias("meta_otif_pct"),
            F.when(F.col("id_almacen") != 3, fixed("95.00")).alias("meta_fill_rate_pct"),
            ((month % 6 != 0) | (F.col("id_almacen") % 5 != 0)).cast("int")
            .alias("es_version_aprobada"),
            F.make_date(F.floor(F.col("periodo") / 100).cast("int"), month, F.lit(1))
            .alias("fecha_carga"),
        )

    def promociones(self) -> DataFrame:
        key = F.col("p_partkey")
        sap = (
            F.when(F.col("p_size") <= 8, F.lit(None))
            .when(F.col("p_size") == 9, "")
            .when(F.col("p_size") == 10, " \t ")
            .when(F.col("p_size") == 11, F.concat(F.lit("SAP-"), key))
            .when(F.col("p_size") == 12, F.concat(F.lit("\t"), F.lpad(key.cast("string"), 8, "0"),
                                                 F.lit(" \n")))
            .otherwise(F.lpad(key.cast("string"), 8, "0"))
        )
        return self.table("part").select(
            F.concat(F.lit("TM-"), key).alias("id_promocion_tm"),
            sap.alias("id_promocion_sap"),
            F.col("p_type").alias("tipo_promocion"),
            F.lit("1995-01-01").cast("date").alias("fecha_carga"),
        )

    def inversion_promocional(self) -> DataFrame:
        # Codes that no promotion has; products of every 17th key have no spend of their own.
        foreign = (F.col("l_linenumber") == 7) | (F.col("l_partkey") % 17 == 0)
        shifted = F.when(foreign, F.col("l_partkey") + 1000000000).otherwise(F.col("l_partkey"))
        return self.lines().select(
            F.when(F.col("l_linenumber") != 6, F.concat(F.lit("TM-"), shifted))
            .alias("id_promocion_tm"),
            F.when(F.col("l_linenumber") % 3 != 0, F.lpad(F.col("l_partkey").cast("string"), 8, "0"))
            .alias("id_promocion_sap"),
            F.col("promo").alias("inversion_soles"),
            F.trunc("dia", "month").alias("fecha_carga"),
        )

    # -- masters ----------------------------------------------------------------

    def clientes(self) -> DataFrame:
        key, segment = F.col("c_custkey"), F.col("c_mktsegment")
        return self.table("customer").select(
            _code("CLI-", key, 9).alias("id_cliente_raw"),
            F.col("c_name").alias("razon_social"),
            _code("20", key, 9).alias("ruc"),
            F.when(key % 4 == 0, "NATURAL").otherwise("JURIDICA").alias("tipo_persona"),
            segment.alias("segmento_comercial"),
            money("c_acctbal").alias("limite_credito_soles"),
            ((key % 4) * 15).alias("dias_credito"),
            F.when(segment != "BUILDING", F.concat(F.lit("Av. "), key)).alias("direccion_fiscal"),
            F.when(key % 10 != 0, F.concat(F.lit("D"), (key % 40).cast("string"))).alias("distrito"),
            F.when(key % 7 != 0, F.concat(F.lit("9"), F.lpad(key.cast("string"), 8, "0")))
            .alias("telefono"),
            F.when(key % 3 != 0, F.concat(F.lit("c"), key, F.lit("@x.pe"))).alias("email_contacto"),
            F.date_add(F.lit("2018-01-01").cast("date"), (key % 2500).cast("int"))
            .alias("fecha_alta_sistema"),
            F.when(F.col("c_acctbal") < 0, "INACTIVO").otherwise("ACTIVO").alias("estado_cliente"),
            F.when(F.col("c_acctbal") >= 0, F.lit(None)).when(key % 5 == 0, "sin fecha")
            .when(key % 5 == 1, "2024-05-20").otherwise("2021-03-15").alias("fecha_baja_sistema"),
        )

    def productos(self) -> DataFrame:
        key = F.col("p_partkey")
        # Every 20th product is assorted: different keys that share all attributes.
        own = lambda column, assorted: F.when(key % 20 == 0, assorted).otherwise(column)
        return self.table("part").select(
            _code("PRD-", key, 9).alias("id_producto_raw"),
            own(F.concat(F.lit("SKU"), key), "SKU-SURTIDO").alias("cod_sku"),
            own(F.concat("p_name", F.lit(" "), key.cast("string")), "SURTIDO").alias("nombre_sku"),
            own(F.col("p_brand"), "SURTIDO").alias("marca"),
            own(F.col("p_type"), "SURTIDO").alias("categoria"),
            own(F.concat("p_type", F.lit("-"), F.expr("p_size div 10").cast("string")), "SURTIDO")
            .alias("subcategoria"),
            own(F.concat(F.lit("LINEA "), F.regexp_substr("p_brand", F.lit(r"\d\z"))), "LINEA 0")
            .alias("linea_negocio"),
            F.lit("UND").alias("unidad_medida"),
            F.concat(F.col("p_size").cast("string"), F.lit(" g")).alias("contenido_neto"),
            money("p_retailprice").alias("precio_lista_soles"),
            F.round(money("p_retailprice")
                    * (F.lit(Decimal("0.60")) + F.col("p_size") * F.lit(Decimal("0.005"))), 2)
            .cast(MONEY).alias("costo_estandar_soles"),
            F.when(F.col("p_size") == 50, "DESCONTINUADO").otherwise("ACTIVO")
            .alias("estado_producto"),
            F.concat(F.lit("S"), F.lpad(key.cast("string"), 8, "0"),
                     F.when(F.col("p_size") == 13, "_DUP").otherwise("")).alias("cod_sap"),
        )

    def canal(self) -> DataFrame:
        found = self.table("orders").select("o_orderpriority").distinct()
        key = F.substring("o_orderpriority", 1, 1).cast("bigint")
        return found.select(
            key.alias("id_canal"),
            F.concat(F.lit("CN"), key).alias("cod_canal"),
            F.expr("substring(o_orderpriority, 3)").alias("nombre_canal"),
            F.when(key <= 2, "moderno").when(key == 3, "tradicional").otherwise("digital")
            .alias("tipo_canal"),
            (F.lit(Decimal("20.00")) + key).cast(MONEY).alias("margen_objetivo_pct"),
        )

    def _nations(self) -> DataFrame:
        return self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))

    def geografia(self) -> DataFrame:
        key = F.col("n_nationkey")
        named = F.element_at(F.array(*[F.lit(d) for d in DEPARTMENTS[:23]]), key + 1)
        return self._nations().select(
            key.cast("bigint").alias("id_geografia"),
            F.lit("PE").alias("pais"),
            F.col("r_name").alias("macroregion"),
            F.when(key < 23, named).otherwise(F.col("n_name")).alias("Departamento"),
            F.concat(F.lit("P"), (key % 10).cast("string")).alias("provincia"),
            F.col("n_name").alias("ciudad"),
            F.concat(F.lit("D"), key.cast("string")).alias("distrito"),
            F.when(key % 3 == 0, "RURAL").otherwise("URBANA").alias("tipo_zona"),
            F.lpad((key * 100).cast("string"), 6, "0").alias("codigo_ubigeo"),
        )

    def almacen(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self._nations().select(
            key.cast("bigint").alias("id_almacen"),
            _code("ALM", key, 3).alias("cod_almacen"),
            F.concat(F.lit("Almacen "), "n_name").alias("nombre_almacen"),
            F.when(key % 3 == 0, "CENTRAL").otherwise("REGIONAL").alias("tipo_almacen"),
            F.col("r_name").alias("macroregion"),
            F.concat(F.lit("R"), (key % 10).cast("string")).alias("region"),
            F.concat(F.lit("P"), (key % 10).cast("string")).alias("provincia"),
            F.col("n_name").alias("ciudad"),
            F.concat(F.lit("D"), key.cast("string")).alias("distrito"),
            F.when(key % 2 == 0, "URBANA").otherwise("RURAL").alias("tipo_zona"),
            F.lit("ACTIVO").alias("estado"),
        )

    def vendedor(self) -> DataFrame:
        """Two sellers share each name and zone, so attributes do not identify a seller."""
        key, pair = F.col("s_suppkey"), F.expr("s_suppkey div 2")
        return self.table("supplier").select(
            key.alias("id_vendedor"),
            _code("VE", key, 6).alias("cod_vendedor"),
            F.concat(F.lit("Vendedor "), pair.cast("string")).alias("nombre_completo"),
            F.when(key % 10 == 0, "SUPERVISOR").otherwise("VENDEDOR").alias("cargo"),
            F.concat(F.lit("Zona "), (pair % 5).cast("string")).alias("zona_asignada"),
            F.date_add(F.lit("2015-01-01").cast("date"), (key % 1000).cast("int"))
            .alias("fecha_ingreso"),
            F.when(F.col("s_acctbal") < 0, "BAJA").otherwise("ACTIVO").alias("estado"),
        )
