"""Curated subject terms by subject and language.

Terms of alphabetic languages are word beginnings (they match any ending), several words where one alone is
ambiguous; a trailing $ makes them match whole words only. Chinese terms match anywhere. A leading ~ marks a weak term, one that other subjects use too. The same term may stand under several subjects. Words that only one corpus uses of a subject
are not listed here: they are learned from its reviewed texts.
"""

TERMS: dict[str, dict[str, str]] = {
    "science": {
        "en": "isotope; neutrino; plasma; crystal lattice; catalyst; fossil layer; spectromet; spectrum; electron beam; laser; comet; magma; vacuum pump; detector; calibrat; particle; physics; physicist; chemist; molecul; atom; proton; quantum; geolog; astronom; telescope; galax; microscop; laborator; enzyme; hypothes; thermodynam; genome; protein; volcan; seismic; ~experiment; ~probe",
        "zh": "同位素; 中子; 等离子; 晶体; 催化剂; 化石; 光谱; 电子束; 粒子; 激光; 彗星; 岩浆; 真空泵; 探测器; 物理学; 化学; 分子; 原子; 地质; 天文; 望远镜; 显微镜; 实验室; 火山; 量子; ~实验",
        "de": "isotop; neutrino; kometen; kristall; messgerät; katalysator; spektromet; teilchen; plasma; physik; chemie; chemisch; molekül; geolog; astronom; teleskop; mikroskop; labor; vulkan; fossil",
        "fr": "isotope; neutrino; comète; cristal; fossile; spectromètre; particule; catalyseur; plasma; physicien; chimie; chimique; molécul; atome; géolog; astronom; télescope; microscop; laboratoire; volcan",
        "es": "isótopo; neutrino; cometa; cristal; fósil; espectrómetro; partícula; catalizador; plasma; físic; químic; molécul; átomo; geolog; geólog; astronom; astrónom; telescopio; microscopi; laboratorio; volc",
        "ru": "изотоп; нейтрин; комет; кристалл; лазерн; спектрометр; частиц; катализатор; плазм; физик; хими; молекул; атом; геолог; астроном; телескоп; микроскоп; лаборатор; вулкан; ископаем",
    },
    "medicine": {
        "en": "vaccine; vaccinat; dialysis; insulin; symptom; allergy; blood sample; wound dressing; surgical; surgeon; surgery; kidney; fever; diagnos; bed rest; patient; clinic; nurse; doctor; hospital; medicin; medication; therap; antibiotic; prescription; disease; epidemic; cancer; blood pressure; ~treatment",
        "zh": "疫苗; 肾脏; 血液样本; 敷料; 透析; 过敏; 药片; 症状; 护理; 病房; 手术; 治疗; 药剂; 用药; 病人; 感染; 胰岛素; 输液; 诊断; 医院; 医生; 护士; 患者; 疾病; 处方; 体温; 发烧; 门诊; 卧床; 抗生素; 医学",
        "de": "blutprobe; medikament; impfdos; impfung; impfstoff; diagnos; patient; arzt; ärzt; krankenhaus; klinik; krankheit; operation; symptom; allergi; therapie; behandlung; fieber; insulin; dialyse; krankenpfleg; rezeptpflichtig",
        "fr": "symptôme; allergie; vaccin; prélèvements de sang; prises de sang; ordonnance; infirmi; traitement; médicament; médecin; hôpita; patient; maladie; chirurg; diagnostic; pansement; dialyse; insuline; fièvre; clinique",
        "es": "enfermera; enfermero; análisis de sangre; alergia; vacuna; receta médica; recetas médicas; síntoma; tratamiento; medicament; médico; hospital; paciente; enfermedad; cirug; diagnóstic; vendaje; diálisis; insulina; fiebre; clínic",
        "ru": "палат; больничн; диагноз; вакцин; лекарств; анализы крови; симптом; повязк; аллерги; врач; больниц; пациент; болезн; хирург; операци; лечени; диализ; инсулин; медсестр; рецепты врача; клиник",
    },
    "law": {
        "en": "lease contract; land register; indictment; court; appeal; arbitration; verdict; statute; jury; injunction; witness; lawsuit; plaintiff; legal guardian; legal; under oath; tenant; ruling; defendant; attorney; lawyer; prosecut; litigation; jurisdiction; contract; testimony; ~settlement",
        "zh": "上诉; 判决; 证人; 租赁合同; 土地登记; 赔偿请求; 起诉; 仲裁; 监护权; 原告; 被告; 驳回; 当事人; 和解协议; 法院; 法庭; 法官; 律师; 法律; 法规; 条款; 陪审; 诉讼; 禁令; 检察; 宣誓; 租客",
        "de": "zeugenaussage; schadensersatz; paragraf; mietvertr; klageschrift; gerichtsurteil; berufungen; gericht; urteil; richter; anwalt; anwält; kläger; angeklagt; gesetz; vertragsrecht; staatsanw; schiedsgericht; vormund; grundbuch",
        "fr": "témoignage; jugement; contrats de bail; contrat de bail; avocat; clauses d arbitrage; arbitrage; tribuna; plainte; juge; juridique; procès; loi; lois; verdict; accusé; procureur; tutelle; cour d appel",
        "es": "demandas; demanda judicial; testigo; cláusula; arbitraje; contratos de alquiler; contrato de alquiler; tribunal; sentencia; abogad; juez; jurídic; juicio; ley; leyes; veredicto; acusado; fiscal; tutela; apelación; indemnización",
        "ru": "договоры аренды; договор аренды; судебн; апелляц; стать закона; статьи закона; иски; иск; решения суда; свидетел; суд; судья; адвокат; закон; юрид; приговор; прокурор; опек; арбитраж; истец; ответчик",
    },
    "sport": {
        "en": "sprint; league; volleyball; referee; home match; squad; relay; marathon; stadium; rowing; penalty kick; podium; training camp; free throw; goalkeeper; athlete; coach; football; basketball; tennis; champion; tournament; olympic; goal; match; scored; striker; ~track",
        "zh": "短跑; 积分榜; 守门员; 点球; 裁判; 训练营; 排球; 比赛; 主场; 赛艇; 接力; 决胜局; 下半场; 球队; 运动员; 教练; 足球; 篮球; 网球; 冠军; 联赛; 马拉松; 体育; 领奖台; 转会; 罚球",
        "de": "heimspiel; elfmeter; trainingslager; torhüter; torwart; schiedsrichter; staffelläuf; staffellauf; tabellenpl; fußball; liga; meisterschaft; mannschaft; athlet; sportler; trainer; stadion; turnier; sprint; marathon; volleyball; wettkampf",
        "fr": "matchs; match à domicile; à domicile; relais; entraînement; arbitre; gardiens de but; gardien de but; championnat; penalty; football; ligue; équipe nationale; athlète; sportif; entraîneur; stade; tournoi; sprint; marathon; volley",
        "es": "partidos en casa; partido; árbitro; penalti; portero; relevos; entrenamiento; liga; ligas; fútbol; campeonato; atleta; deportist; entrenador; estadio; torneo; esprint; maratón; voleibol; goles",
        "ru": "тренировк; домашние матчи; матч; эстафет; турнирн; пенальти; вратар; футбол; лига; чемпионат; спортсмен; спорт; тренер; стадион; марафон; волейбол; спринт; гол; соревнован",
    },
    "software": {
        "en": "release branch; parser; pull request; stack trace; memory leak; database; build server; message queue; config file; unit test; thread pool; scheduler; race condition; slow query; package manager; endpoint; software; source code; compiler; algorithm; api; debug; bug; backend; frontend; deploy; repository; javascript; python; docker; kernel; web server; ~server; ~index",
        "zh": "解析器; 内存泄漏; 泄漏; 缓存; 配置文件; 消息队列; 数据库; 索引; 服务器; 单元测试; 查询; 调度器; 竞态; 回滚; 软件; 程序; 代码; 编译; 算法; 接口; 调试; 部署; 线程; 合并请求; 堆栈",
        "de": "speicherleck; testläuf; softwarepaket; software; datenbank; serverprotokoll; programmfehler; schnittstelle; server; quellcode; programmier; compiler; algorithm; entwickler; debug; bibliothek von funktionen; webseite; betriebssystem",
        "fr": "tests unitaires; modules; serveur; bases de données; base de données; bogue; logiciel; fichiers de configuration; code source; programmeur; programmation; compilateur; algorithm; développeur; débog; interface de programmation; informatique",
        "es": "servidor; pruebas unitarias; módulos; errores del programa; dependencias; archivos de configuración; bases de datos; base de datos; software; código fuente; programador; programación; compilador; algoritmo; desarrollador; depura; informátic",
        "ru": "сервер; программн; базы данных; база данных; утечки памяти; модульные тесты; код; программист; программирован; компилятор; алгоритм; разработчик; отладк; софт; интерфейс",
    },
    "finance": {
        "en": "mortgage; dividend; loan; currency; premium; insurance; hedge; audit report; audit; savings bond; share price; pension fund; balance sheet; credit line; interest margin; bond; bank; invest; stock market; shareholder; portfolio; accounting; inflation; tax; fiscal; ~interest",
        "zh": "分红; 利率; 债券; 房贷; 股价; 储蓄; 贷款; 养老基金; 基金; 信用额度; 额度; 审计; 资产负债; 账簿; 银行; 投资; 股票; 保险; 保费; 货币; 汇率; 会计; 财务; 金融; 对冲; 税",
        "de": "versicherungsprämie; aktienkurs; aktie; sparanleihe; anleihe; kredit; dividende; zinss; zins; bilanz; bank; banken; investition; börse; versicherung; währung; hypothek; buchhaltung; rentenfonds; steuer; finanz",
        "fr": "prêts bancaires; prêt bancaire; bancaire; banque; dividende; les actions; bilans comptables; comptable; obligation; primes d assurance; assurance; taux d intérêt; intérêt; bourse de; investiss; monnaie étrangère; hypothè; finance; financi; impôt",
        "es": "tipos de interés; interés; balances; préstamo; bonos; dividendo; acciones; primas de seguro; seguro; banco; bancari; inversión; inversor; bolsa de; moneda extranjera; hipoteca; contab; finanz; financier; impuesto",
        "ru": "курсы акций; акци; дивиденд; облигац; кредит; процентные ставки; процентн; балансы; страховые взносы; страхов; банк; инвестиц; бирж; валют; ипотек; бухгалтер; финанс; налог; пенсионный фонд",
    },
    "farming": {
        "en": "silo; harvester; harvest; dairy; sheep; pasture; compost; barley; cattle; irrigation; fodder; crop; orchard; beehive; hail; winter wheat; wheat; soil sample; soil; greenhouse; livestock; farm; tractor; plough; fertili; poultry; vineyard; ~meadow",
        "zh": "牛群; 播种; 奶牛; 羊圈; 灌溉; 土壤; 温室; 果园; 收割机; 麦田; 大麦; 堆肥; 冬小麦; 小麦; 苹果树; 草地; 饲料; 农业; 农场; 农民; 庄稼; 作物; 牲畜; 拖拉机; 收成; 冰雹; 蜂箱; 轮作",
        "de": "bodenprobe; bewässerung; mähdrescher; obstb; gewächsh; ernte; bauernh; landwirt; vieh; traktor; weizen; acker; dünger; weide; saatgut; stall; kompost",
        "fr": "verger; moisson; vaches; laitière; serres; orge; irrigation; semence; récolte; ferme$; fermes$; fermier; agricult; agricole; bétail; tracteur; blé; engrais; pâturage; compost; élevage",
        "es": "invernadero; huerto; vacas; lechera; cosecha; semilla; cebada; acequia; riego; granja; agricult; agrícola; ganado; tractor; trigo; fertilizante; pasto; compost; ganader",
        "ru": "теплиц; почв; сады; оросительн; стада; ячменн; комбайн; урожа; ферм; сельск; скот; трактор; пшениц; удобрен; пастбищ; компост; посев",
    },
    "education": {
        "en": "exam; school; homework; kindergarten; timetable; report card; pupil; curriculum; textbook; scholarship; teacher; seminar; lesson plan; lesson; classroom; student; university; teach; educat; tuition; diploma",
        "zh": "课程; 幼儿园; 试卷; 家庭作业; 作业; 教案; 教室; 教科书; 奖学金; 班级; 期末考试; 考试; 作文; 学校; 老师; 教师; 学生; 大学; 教育; 成绩单; 课堂; 听写",
        "de": "leseübung; hausaufgabe; schulklasse; schul; lehrbüch; lehrbuch; stundenpl; prüfungsb; prüfung; unterricht; lehrer; schüler; student; universität; stipendi; kindergarten; zeugnis; pädagog",
        "fr": "enseignant; bourses d études; élèves; devoirs; examen; manuels scolaires; scolaire; salles de classe; école; professeur; étudiant; université; diplôme; cours de; pédagog; éducati; leçon",
        "es": "maestro; exámenes; examen; alumno; libros de texto; deberes; becas; aulas; escuela; escolar; profesor; estudiante; universidad; diploma; pedagog; educaci; lección",
        "ru": "расписания уроков; уроки; уроков; экзамен; школьн; школа; учител; стипенди; домашние задания; учебник; ученик; студент; университет; образован; педагог; диплом; детский сад",
    },
    "history": {
        "en": "chronicle; shipwreck; burial mound; siege; royal charter; trade guild; peace treaty; treaty; bronze coin; monastery; cavalry; truce; besieg; excavation; dynasty; archaeolog; medieval; ancient; empire; emperor; century; historian; king; kingdom; pharaoh; revolution; ~regiment",
        "zh": "编年史; 铜币; 行会; 诏书; 沉船; 古墓; 王朝; 城墙; 遗址; 和约; 停战; 炉灶; 围城; 手抄; 考古; 古代; 皇帝; 国王; 帝国; 历史; 战争; 朝代; 骑兵",
        "de": "klosterarchiv; chronik; grabhügel; friedensvertr; bronzemünz; belagerung; urkunde; dynasti; könig; kaiser; mittelalter; archäolog; antike; histor; geschichte des; reich der; ritter; schlacht",
        "fr": "monastère; épave; traités de paix; traité; dynastie; siège; sièges; charte; royale; roi; empereur; médiéval; archéolog; antiqu; historien; histori; bataille; chevalier",
        "es": "asedio; dinastía; monasterio; tratados de paz; tratado; naufragio; rey; reyes; emperador; medieval; arqueolog; arqueólog; antigüedad; historiador; histórico; batalla; caballero",
        "ru": "осад; курган; монастырск; царск; мирные договоры; мирный договор; летопис; монет; династи; король; импера; средневеков; археолог; древн; историк; историч; битв; рыцар",
    },
    "travel": {
        "en": "border crossing; coastal road; coastal path; hostel; ferry; night train; harbour; terminal; mountain hut; boarding pass; city map; cable car; lighthouse; campsite; island tour; tourist; travel; hotel; sightseeing; itinerary; passport; luggage; airport; vacation; backpack; trip",
        "zh": "徒步; 渡轮; 火车; 边境; 山间小屋; 行李; 码头; 露营; 城市地图; 地图; 路线; 旅舍; 海岸公路; 港口; 山口; 换乘; 旅行; 旅游; 游客; 酒店; 景点; 护照; 机场; 缆车; 灯塔; 登机牌",
        "de": "grenzüberg; berghütt; herberge; wanderweg; fährh; fähre; stadtpl; nachtz; reise; tourist; urlaub; hotel; bahnhof; flughafen; koffer; strand; zeltplatz; seilbahn; sehenswürdig; unterkunft",
        "fr": "visites guidées; frontière; trains de nuit; train de nuit; ferries; ferry; sentier; refuges de montagne; refuge; auberge; voyage; touris; hôtel; bagage; aéroport; gare; vacances; passeport; téléphérique; camping; itinéraire",
        "es": "visitas guiadas; refugios de montaña; refugio; albergue; trenes nocturnos; senderos; sendero; la costa; frontera; transbordador; viaje; turis; hotel; equipaje; aeropuerto; vacaciones; pasaporte; teleférico; camping; itinerario",
        "ru": "пограничн; карты города; хостел; паром; пешие маршруты; маршрут; ночные поезда; поезд; приют; путешеств; турист; туризм; отел; гостиниц; багаж; аэропорт; отпуск; вокзал; паспорт; экскурс",
    },
    "music": {
        "en": "melody; piano score; piano; chord; flute; songwriter; string quartet; concert; choir; rehearsal; quartet; recording studio; overture; opera; bass line; drum; the chorus; slow movement; music; orchestra; symphon; violin; guitar; album; composer; singer; ~rehearsed",
        "zh": "合唱; 排练; 录音棚; 录音; 钢琴; 弦乐; 四重奏; 旋律; 和弦; 低音; 音乐; 长笛; 慢板; 副歌; 歌曲; 独奏; 乐队; 乐谱; 演奏; 作曲; 歌手; 交响; 歌剧; 吉他; 铜管",
        "de": "melodie; streichquartett; konzerts; konzert; klavier; chorprobe; chor; flöte; akkord; musik; orchester; sinfonie; geige; gitarre; komponist; sänger; oper; lied; schlagzeug; partitur",
        "fr": "mélodie; salles de concert; concert; flûte; chorale; accords; piano; partition; quatuor; musique; musicien; musical; orchestre; symphoni; violon; guitare; compositeur; chanteu; opéra; chanson; batterie",
        "es": "partitura; piano; flauta; coros; melodía; cuarteto; acordes; salas de conciertos; concierto; música; músico; musical; orquesta; sinfon; violín; guitarra; compositor; cantante; ópera; canción; batería",
        "ru": "хоров; хоры; флейт; струнн; фортепиано; аккорд; концертн; концерт; мелоди; ноты; музык; оркестр; симфон; скрипк; гитар; композитор; певец; опера; песн; квартет; барабан",
    },
    "food": {
        "en": "bread dough; bread; sauce; cast iron; dough; cheese; kitchen brigade; tart; broth; spice; soup; onion; whisked; butter; simmered; baked; tasting menu; pepper; pickle; recipe; cook; cuisine; restaurant; chef; dessert; ingredient; kitchen; ~dish",
        "zh": "面团; 铸铁锅; 熏鱼; 香料; 柠檬; 奶酪; 洋葱; 泡菜; 米饭; 酱汁; 腌; 高汤; 面包; 烤; 食谱; 烹饪; 餐厅; 厨师; 厨房; 美食; 甜点; 食材",
        "de": "reisgericht; zwiebelsupp; räucherfisch; kuchenrezept; gewürz; brotteig; käse; suppe; soße; brot; kuchen; koch; küche; rezept; restaurant; gericht mit; nachtisch; zutat; butter; teig",
        "fr": "fromage; sauce; soupe; oignon; tarte; citron; épice; beurre; cuisin; recette; restaurant; dessert; ingrédient; pain; riz; gâteau; plat principal",
        "es": "sopa; cebolla; tarta; salsa; mantequilla; arroz; queso; especias; limón; pan; cocin; receta de; restaurante; postre; ingrediente; plato principal",
        "ru": "супы; суп; луковые; сыр; сыры; сыров; сыра$; прян; тесто; соус; рис; риса; пирог; кухн; рецепт пирога; ресторан; повар; блюд; десерт; масло; хлеб",
    },
}
